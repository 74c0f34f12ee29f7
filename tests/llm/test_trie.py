import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from cratedig.llm.trie import branched_trie, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, pos int, D1 string"


def turns_of(rows):
    out = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            out[c].append((t is not None, t or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    # halves of the digest order as signed numbers
    half = lambda d: (int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True))
    return {c: [x[3:] for x in sorted(v, key=lambda x: (x[0], x[1], half(x[2])))] for c, v in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = c - abs(c) % 5 * (1 if c >= 0 else -1)
        out[c] = convs.get(rest, [])[:h] + own[h:]
    return out


def plain(convs):
    """The nodes by the definition: every prefix of every conversation by its turns."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, leaves, saved = (defaultdict(int) for _ in range(3))
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def fixture():
    rnd = random.Random(6)
    words = ["", "a", "é😀", None, "long " * 30]
    rows = []
    for c in [*range(-12, 60), 10**15, -(2**40)]:
        rows += [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(words), 1, "x") for t in range(rnd.randint(1, 14))]
    deep = [(t, "user", f"t{t}") for t in range(700)]
    rows += [(1001, *x, 1, "x") for x in deep] + [(1002, *x, 1, "x") for x in deep[:650]] + [(1007, *x, 1, "x") for x in deep]
    rows += [(5, None, "user", "first", 1, "x"), (5, None, "user", "other", 1, "x"), (None, 1, "user", "nobody", 1, "x")]
    rows += [(77, 3, "user", "again", 1, "x")] * 20
    rnd.shuffle(rows)
    return rows


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("cells", [1 << 22, 64])
def test_nodes_equal_the_definition(spark, cells):
    rows = fixture()
    got = branched_trie(spark.createDataFrame(rows, SCHEMA), cells=cells).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rebuilt(turns_of(rows)))


def test_blocks_of_a_long_conversation(spark):
    rows = [(c, t, "user", f"{t}", 1, "x") for c in (1, 2) for t in range(2500 + c)] + [(3, t, "user", "same", 1, "x") for t in range(1100)]
    got = prefix_trie(spark.createDataFrame(rows, SCHEMA)).select(*COLUMNS).collect()
    by = {(r.conv_id, r.depth): r for r in got}
    assert len(got) == 1 + 2502 + 1100
    assert by[1, 0][3:7] == (3, 2, 2, sum(len(str(t)) for t in range(2501)))
    assert by[1, 2501].ends_sha256 == hashlib.sha256(b"1").hexdigest()
    assert by[2, 2502][2:7] == (1, 1, 0, 1, 0)


def test_many_members_end_at_one_node(spark):
    rows = [(c, 0, "user", "hi", 1, "x") for c in range(9000)]
    got = {r.depth: r for r in prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].ends_sha256 == hashlib.sha256(",".join(map(str, range(9000))).encode()).hexdigest()
    assert (got[0].n_convs, got[0].n_children, got[0].saved_tokens, got[0].n_leaves) == (9000, 1, 8999 * 2, 1)


def test_empty(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert branched_trie(spark.createDataFrame([(None, 1, "user", "x", 1, "x")], SCHEMA)).count() == 0
