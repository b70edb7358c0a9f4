"""Dedupe, watermark and merge properties (C2-C5), exact grouped median."""
import datetime as dt
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.operators.core import (dedupe_latest, merge_snapshot, watermark_filter)
from contactlake.operators.percentile import grouped_percentile_cont
from contactlake.schema import CONTACT_COLUMNS, CONTACT_SCHEMA

D = dt.datetime


def contacts(spark, rows):
    """rows: (contact_id, created_at, lastmodifieddate, processed_at, ingest_seq)."""
    full = [(cid, f"{cid}@x.com", None, None, None, None, None, None, None, c, lm, "NEW",
             None, None, p, "r", seq) for cid, c, lm, p, seq in rows]
    schema = T.StructType(CONTACT_SCHEMA.fields + [T.StructField("ingest_seq", T.LongType())])
    return spark.createDataFrame(full, schema)


def test_dedupe_order(spark):
    df = contacts(spark, [("1", D(2024, 1, 1), None, D(2024, 1, 5), 1),
                          ("1", D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3), 2),   # lmd wins
                          ("2", D(2024, 1, 1), None, D(2024, 1, 3), 3),
                          ("2", D(2024, 1, 1), None, D(2024, 1, 3), 4)])           # last wins
    got = {r["contact_id"]: r["ingest_seq"] for r in dedupe_latest(df).collect()}
    assert got == {"1": 2, "2": 4}


def test_merge_moves_partition(spark):
    """FIXTURES §5 merge case: id 9 moves from day 1 to day 40, no stale copy."""
    target = contacts(spark, [("1", D(2024, 1, 1), None, D(2024, 1, 1), 1),
                              ("9", D(2024, 1, 1), None, D(2024, 1, 1), 2)])
    source = contacts(spark, [("9", D(2024, 2, 9), None, D(2024, 3, 1), 3),
                              ("4", D(2024, 1, 2), None, D(2024, 3, 1), 4)])
    snap = merge_snapshot(target, source, mode="run", now="2024-03-02 00:00:00")
    rows = {r["contact_id"]: r for r in snap.collect()}
    assert sorted(rows) == ["1", "4", "9"]
    assert rows["9"]["created_at"] == D(2024, 2, 9)
    assert source.select("contact_id").distinct().count() == 2          # affected
    again = merge_snapshot(snap, source, mode="run", now="2024-03-03 00:00:00")
    a = sorted(tuple(r[c] for c in CONTACT_COLUMNS if c != "processed_at") for r in again.collect())
    b = sorted(tuple(r[c] for c in CONTACT_COLUMNS if c != "processed_at") for r in snap.collect())
    assert a == b                                                       # idempotent


def test_watermark_is_strict(spark):
    target = contacts(spark, [("1", D(2024, 1, 1), None, D(2024, 1, 10), 1)])
    src = contacts(spark, [("2", D(2024, 1, 1), None, D(2024, 1, 10), 2),
                           ("3", D(2024, 1, 1), None, D(2024, 1, 11), 3)])
    assert [r["contact_id"] for r in watermark_filter(src, target).collect()] == ["3"]
    assert watermark_filter(src, target.limit(0)).count() == 2          # empty target


def test_grouped_median_matches_brute_force_with_hot_group(spark):
    rnd = random.Random(7)
    rows = [("hot", rnd.randint(1, 5000)) for _ in range(3000)]          # a third+ of rows
    rows += [(g, rnd.randint(1, 100)) for g in ("a", "b", None) for _ in range(rnd.randint(1, 40))]
    rows += [("single", 42)]
    df = spark.createDataFrame(rows, "g string, v long")
    got = {r["g"]: r["p"] for r in grouped_percentile_cont(df, ["g"], "v", 0.5, "p").collect()}
    want = {}
    for g in {r[0] for r in rows}:
        want[g] = float(statistics.median(sorted(v for k, v in rows if k == g)))
    assert got == want
    q = {r["g"]: r["p"] for r in grouped_percentile_cont(df, ["g"], "v", 0.9, "p").collect()}
    hot = sorted(v for k, v in rows if k == "hot")
    pos = (len(hot) - 1) * 0.9
    lo, frac = int(pos), pos - int(pos)
    assert abs(q["hot"] - (hot[lo] + (hot[lo + 1] - hot[lo]) * frac)) < 1e-9


def merged(spark, path, df, tmpdir_path, **kw):
    from contactlake.sources import corestore
    return corestore.merge(spark, path, df.select(*CONTACT_COLUMNS), os.path.join(tmpdir_path, "stage"), **kw)


def core_rows(spark, path):
    from contactlake.sources import sinks
    return {r["contact_id"]: r["created_at"] for r in sinks.read_core(spark, path).collect()}


def test_merge_moves_contact_and_drops_empty_month(spark, tmpdir_path):
    core = os.path.join(tmpdir_path, "core")
    target = contacts(spark, [("1", D(2024, 1, 1), None, D(2024, 1, 1), 1),
                              ("8", D(2024, 2, 1), None, D(2024, 1, 1), 1),
                              ("9", D(2024, 3, 1), None, D(2024, 1, 1), 2)])   # only row of March
    first = merged(spark, core, target, tmpdir_path)
    source = contacts(spark, [("9", D(2024, 5, 9), None, D(2024, 6, 1), 3),
                              ("4", D(2024, 1, 2), None, D(2024, 6, 1), 4)])
    got = merged(spark, core, source, tmpdir_path)
    assert got["rewritten"] == ["2024-01-01", "2024-03-01", "2024-05-01"] and got["affected"] == 2
    want = {"1": D(2024, 1, 1), "4": D(2024, 1, 2), "8": D(2024, 2, 1), "9": D(2024, 5, 9)}
    assert core_rows(spark, core) == want and sorted(got["data"]) == ["2024-01-01", "2024-02-01", "2024-05-01"]
    assert got["data"]["2024-02-01"] == first["data"]["2024-02-01"]            # February was not touched
    again = merged(spark, core, source, tmpdir_path)                           # re-run
    assert core_rows(spark, core) == want and again["keys"] == 4
    assert again["index"] == got["index"]                                      # nothing new or moved: kept as it is
    # a month of an older version is gone, the version before the last one stays readable
    assert not os.path.exists(os.path.join(core, "data", f"merge={first['data']['2024-03-01']}", "created_month=2024-03-01"))
    from contactlake.sources import corestore
    assert corestore.read(spark, core, got).count() == 4


def test_merges_of_random_batches_match_a_dict(spark, tmpdir_path, monkeypatch):
    """Dated, undated and moved contacts; buckets that split; the index is the core's keys."""
    from contactlake.sources import corestore
    monkeypatch.setattr(corestore, "KEYS_PER_BUCKET", 4)
    rnd, want, core = random.Random(5), {}, os.path.join(tmpdir_path, "core")
    for k in range(6):
        batch = {str(rnd.randint(1, 40)): rnd.choice([None, D(2024, rnd.randint(1, 4), rnd.randint(1, 28))])
                 for _ in range(rnd.choice([1, 8, 15]))}
        if k == 3:
            batch = {i: None for i in batch}
        want |= batch
        got = merged(spark, core, contacts(spark, [(i, c, None, D(2024, 1, 1 + k), 1) for i, c in batch.items()]), tmpdir_path)
        assert core_rows(spark, core) == want and got["keys"] == len(want)
        assert got["watermark"] == f"2024-01-0{1 + k} 00:00:00.000000"
        index = corestore.read_index(spark, core, got, set(range(got["buckets"]))).collect()
        assert {r["contact_id"]: r["created_month"] for r in index} == {i: c and c.date().replace(day=1) for i, c in want.items()}
        assert len(index) == len(want)
    assert got["buckets"] > 1


def test_a_merge_opens_only_its_buckets_and_months(spark, tmpdir_path, monkeypatch):
    from contactlake.sources import corestore
    monkeypatch.setattr(corestore, "KEYS_PER_BUCKET", 10)
    core = os.path.join(tmpdir_path, "core")
    many = contacts(spark, [(str(i), D(2024, 1 + i % 12, 1), None, D(2024, 1, 1), i) for i in range(200)])
    first = merged(spark, core, many, tmpdir_path)
    opened = {"data": [], "index": []}
    for name, part in (("read", "data"), ("read_index", "index")):
        real = getattr(corestore, name)
        monkeypatch.setattr(corestore, name, lambda *a, real=real, part=part: opened[part].append(a[-1]) or real(*a))
    got = merged(spark, core, contacts(spark, [("7", D(2024, 8, 5), None, D(2024, 2, 1), 1)]), tmpdir_path)
    assert opened["data"] == [{"2024-08-01"}] and [len(b) for b in opened["index"]] == [1, 0]
    assert first["buckets"] > 8 and got["index"] == first["index"] and got["keys"] == 200


def test_a_failed_merge_leaves_the_version_before(spark, tmpdir_path, monkeypatch):
    from contactlake.sources import corestore
    core = os.path.join(tmpdir_path, "core")
    merged(spark, core, contacts(spark, [("1", D(2024, 1, 1), None, D(2024, 1, 1), 1)]), tmpdir_path)
    monkeypatch.setattr(corestore, "_publish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        merged(spark, core, contacts(spark, [("1", D(2024, 2, 1), None, D(2024, 1, 1), 1)]), tmpdir_path)
    assert core_rows(spark, core) == {"1": D(2024, 1, 1)}
    monkeypatch.undo()
    assert merged(spark, os.path.join(tmpdir_path, "none"), contacts(spark, []), tmpdir_path)["affected"] == 0
