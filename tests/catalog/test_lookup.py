import re
import uuid

import pytest

from cratedig.operators.lookup import PUSHED, lookup
from cratedig.operators.store import write_table
from cratedig.schemas import TABLES

N = 3000


def name(i):
    return str(uuid.uuid5(uuid.NAMESPACE_DNS, str(i)))


def frame(spark, table, rows):
    names = TABLES[table].names
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], TABLES[table].columns)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lookup")
    rows = {
        "artists": [{"mbid": name(i), "name": f"a{i}"} for i in range(N)],
        "release_groups": [{"mbid": name(N), "title": "group"}],
        "releases": [{"mbid": name(2 * N + i), "title": f"r{i}", "barcode": f"{i % 700:04d}" if i % 3 else None} for i in range(N)],
        # one value as an id and as ISRC of others, a null and a common ISRC
        "recordings": [{"mbid": "X1", "title": "by id"}] + [{"mbid": name(4 * N + i), "title": f"c{i}"} for i in range(N)],
        "recording_isrcs": [{"recording_mbid": "X1", "isrc": "X1"}, {"recording_mbid": name(4 * N), "isrc": "X1"}, {"recording_mbid": name(4 * N + 1), "isrc": None}]
        + [{"recording_mbid": name(4 * N + i), "isrc": "COMMON"} for i in range(1000)]
        + [{"recording_mbid": name(4 * N + i), "isrc": "SOME"} for i in range(PUSHED)]
        + [{"recording_mbid": "absent", "isrc": "COMMON"}],
        "tracks": [{"mbid": "X1", "title": "track"}],
    }
    for table, found in rows.items():
        write_table(table, frame(spark, table, found).repartition(3), str(root / table))
    return {t: spark.read.schema(TABLES[t].columns).parquet(str(root / t)) for t in rows}


def found(tables, value):
    return sorted(map(tuple, lookup(tables, value).collect()))


def test_exact_values(tables):
    assert found(tables, name(7)) == [("artist", "mbid", name(7), "a7")]
    assert found(tables, name(7).upper()) == []
    assert found(tables, "no such value") == []
    assert found(tables, name(N)) == [("release_group", "mbid", name(N), "group")]
    assert found(tables, "0010") == sorted(("release", "barcode", name(2 * N + i), f"r{i}") for i in range(N) if i % 3 and i % 700 == 10)
    assert found(tables, "X1") == sorted([("recording", "mbid", "X1", "by id"), ("recording", "isrc", name(4 * N), "c0"), ("track", "mbid", "X1", "track")])
    with pytest.raises(ValueError, match="empty"):
        lookup(tables, "")


@pytest.mark.parametrize(("isrc", "n"), [("SOME", PUSHED), ("COMMON", 1000)])
def test_an_isrc_of_many_recordings(tables, isrc, n):
    assert found(tables, isrc) == sorted(("recording", "isrc", name(4 * N + i), f"c{i}") for i in range(n))


def scanned(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_bloom_filters_skip_row_groups(spark, tables, tmp_path):
    # ids that no artist has, within the range of those that have one
    low, high = (tables["artists"].selectExpr(f"{f}(mbid)").first()[0] for f in ("min", "max"))
    absent = [x for x in (name(-1 - i) for i in range(40)) if low < x < high][:20]
    plain = str(tmp_path / "plain")
    tables["artists"].write.parquet(plain)
    without = spark.read.parquet(plain)
    assert sum(scanned(without.where(without.mbid == x)) for x in absent) > 10 * N
    assert sum(scanned(tables["artists"].where(tables["artists"].mbid == x)) for x in absent) <= 2 * N
    # the row that is there comes from one of three files
    assert 1 <= scanned(tables["artists"].where(tables["artists"].mbid == name(5))) < N
    plan = lookup(tables, name(5))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PushedFilters: \[[^\]]*EqualTo\((?:mbid|barcode)", plan)) >= 4
