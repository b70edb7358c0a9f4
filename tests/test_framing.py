"""Documents and rows across lines and scan splits: any split gives the result of none."""
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from contactlake.constants import CSV_COLUMNS
from contactlake.operators.validate import validate_api, validate_csv
from contactlake.sources import framing, readers


def frame(text: str, kind: str, cuts=()):
    """(line, at, doc) of a text cut into splits before the given lines, through the machines."""
    lines = text.split("\n")
    edges = [0, *sorted(set(cuts)), len(lines)]
    splits = [lines[a:b] for a, b in zip(edges, edges[1:]) if b > a]
    machine, then = (framing.Json, framing.Effect.then) if kind == "json" else (framing.Csv, framing.Turns.then)
    rows = []
    for k, part in enumerate(splits):
        e = framing.Effect()
        for x in part:
            e = then(e, machine.effect(x))
        rows.append({"file": "f", "start": k, "lines": e.lines, "closes": e.closes, "opens": e.opens, "kinds": e.kinds,
                     "reset": e.reset, "begins": e.begins, "last": e.last})
    known, across = framing.begins(rows, kind)
    units = []
    for k, part in enumerate(splits):
        number, state = known["f", k]
        u = (framing.JsonUnits if kind == "json" else framing.CsvUnits)("f", number, framing.replace(state), k == 0)
        for x in part:
            u.line(x)
        u.finish()
        units += u.rows
    out = [(r[2], r[3], r[8]) for r in units if r[5] and r[1] != "header"]
    parts = [r for r in units if not r[5]]
    assert not parts or across
    for kind_ in {r[1] for r in parts} - {"header"}:
        groups = []
        for r in sorted((r for r in parts if r[1] == kind_), key=lambda r: (r[2], r[3])):
            if r[4]:
                groups.append([])
            groups[-1].append(r)
        for g in groups:
            if sum(r[6] for r in g) > framing.RECORD_BYTES:
                out += [(r[2] + k, 0, x) for r in g for k, x in enumerate(r[8].split("\n")) if x.strip()]
            else:
                doc = "".join("\n" * (r[2] - b[7] if b else 0) + r[8] for b, r in zip([None, *g], g))
                out += [(g[0][2], g[0][3], doc)] if doc.strip() else []
    return sorted(out)


def contact(rnd, i):
    return {"id": str(i), "properties": {"email": f"a{i}@b.com", "company": rnd.choice(["", "x}y", '"q"', "a\nb", "{[,", "\\"])}}


def json_text(rnd):
    """A file of documents of all layouts, and some that are torn; the ids that are whole."""
    out, ids = [], []
    for _ in range(rnd.randint(1, 8)):
        some = [contact(rnd, rnd.randrange(10**6)) for _ in range(rnd.randint(0, 3))]
        page = {"results": some, "paging": {"next": {"after": "1"}}}
        if rnd.random() < 0.3:
            page = dict(reversed(page.items()))
        doc = rnd.choice([page, some, some[0] if some else page])
        text = json.dumps(doc, indent=rnd.choice([None, 2, 0]))
        shown = rnd.choice(["", " ", "\n", "\n\n"]).join([text] * rnd.choice([1, 1, 2]))
        out.append(shown)
        ids += [c["id"] for c in ([doc] if "id" in doc else some)] * shown.count(text)
    return "\n".join(out), ids


def ids_of(docs):
    got = []
    for doc in docs:
        v = json.loads(doc)
        v = v["results"] if "results" in v else v
        got += [c["id"] for c in (v if isinstance(v, list) else [v])]
    return got


@pytest.mark.parametrize("seed", range(60))
def test_json_of_any_layout_and_split(seed):
    rnd = random.Random(seed)
    text, ids = json_text(rnd)
    whole = frame(text, "json")
    assert ids_of(d for _, _, d in whole) == ids
    lines = text.count("\n") + 1
    for _ in range(8):
        cuts = [rnd.randrange(1, lines) for _ in range(rnd.randint(1, lines))] if lines > 1 else []
        assert frame(text, "json", cuts) == whole, cuts


@pytest.mark.parametrize("seed", range(60))
def test_torn_lines_lose_no_text_and_do_not_depend_on_splits(seed, monkeypatch):
    monkeypatch.setattr(framing, "RECORD_BYTES", random.Random(seed).choice([30, 1 << 20]))
    rnd = random.Random(seed)
    bits = ['{"id":"%d"}', '{"id":"%d", torn', '{"id":"%d', "]", "}}", '{"a": [', "trailing %d", '"x", %d', "[", "", "[1,", '{"results":[{"id":"%d"},', ']}']
    text = "\n".join((b % k if "%d" in b else b) for k, b in enumerate(rnd.choice(bits) for _ in range(rnd.randint(1, 25))))
    whole = frame(text, "json")
    kept = "".join(d for _, _, d in whole)
    for sign in [c for c in text if c.isalnum()]:
        assert sign in kept
    assert sum(c.isalnum() for c in kept) == sum(c.isalnum() for c in text)
    lines = text.count("\n") + 1
    for _ in range(8):
        cuts = [rnd.randrange(1, lines) for _ in range(rnd.randint(1, lines))] if lines > 1 else []
        assert frame(text, "json", cuts) == whole, cuts


def test_good_lines_around_a_torn_one():
    text = '{"a": [\n{"id":"1"}\n{"id":"2"}\n{"id":"3", "x\n{"id":"4"} rest\n{"id":"5"}{"id":"6"}'
    docs = [d for _, _, d in frame(text, "json")]
    assert docs == ['{"a": [\n{"id":"1"}', '{"id":"2"}', '{"id":"3", "x', '{"id":"4"}', " rest", '{"id":"5"}', '{"id":"6"}']


@pytest.mark.parametrize("seed", range(40))
def test_csv_cells_with_line_breaks(seed):
    rnd = random.Random(seed)
    cells = ["a", "", '"x,y"', '"two\nlines"', '"say ""hi""\n\nno"', 'in"ner', '""', '"\n"', '"a" b']
    rows = [",".join(rnd.choice(cells) for _ in range(3)) for _ in range(rnd.randint(1, 12))]
    text = "\n".join(["h1,h2,h3", *rows])
    whole = frame(text, "csv")
    assert [d for _, _, d in whole] == [r for r in rows if r.strip()]
    lines = text.count("\n") + 1
    for _ in range(6):
        assert frame(text, "csv", [rnd.randrange(1, lines) for _ in range(rnd.randint(1, lines))]) == whole


def landed(folder, files):
    os.makedirs(folder)
    for name, text in files.items():
        with open(os.path.join(folder, name), "w", newline="") as fh:
            fh.write(text)
    return folder


def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture()
def splits(spark):
    yield lambda size: small_splits(spark, size)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_read_alike_in_any_split(spark, tmpdir_path, splits):
    rnd = random.Random(5)
    texts = {f"{k}.json": json_text(rnd) for k in range(5)}
    texts["bad.json"] = ('torn {"id\n' + json.dumps([contact(rnd, k) for k in range(20)], indent=2)
                         + ' {"id":"7","properties":{}} tail', [str(k) for k in range(20)] + ["7"])
    folder = landed(os.path.join(tmpdir_path, "in"), {n: t for n, (t, _) in texts.items()})
    want = sorted(i for _, ids in texts.values() for i in ids)
    seen = []
    for size in (64, 300, 1 << 20):
        splits(size)
        rows = readers.read_api_contacts(spark, folder).select("id", "ingest_seq", F.to_json("raw").alias("raw")).collect()
        assert sorted(r.id for r in rows if r.id is not None) == want
        assert len({r.ingest_seq for r in rows}) == len(rows)
        seen.append(sorted(rows, key=lambda r: r.ingest_seq))
    assert seen[0] == seen[1] == seen[2]
    assert {json.loads(r.raw) for r in seen[0] if r.id is None} == {'torn ', '{"id', " tail"}


def test_csv_read_alike_in_any_split(spark, tmpdir_path, splits):
    head = ",".join(CSV_COLUMNS)
    row = '%d,u%d@b.com,A,B,"Co\n""%d""\n\nLtd",T,5,2024-01-15T10:30:00Z'
    files = {n: head + "\n" + "\n".join(row % (k, k, k) for k in range(a, b)) + "\n%d,short" % (b + 100)
             for n, a, b in (("a.csv", 0, 30), ("b.csv", 30, 31))}
    folder = landed(os.path.join(tmpdir_path, "in"), files)
    seen = []
    for size in (50, 200, 1 << 20):
        splits(size)
        rows = readers.read_csv_contacts(spark, folder)
        assert size > 200 or rows.rdd.getNumPartitions() > 5
        got = validate_csv(rows).select("contact_id", "company_name", "error_type", "ingest_seq", "original_data").collect()
        good = [r for r in got if r.error_type is None]
        assert sorted(int(r.contact_id) for r in good) == list(range(31))
        assert {r.company_name for r in good} == {f'Co\n"{k}"\n\nLtd' for k in range(31)}
        assert sorted(json.loads(r.original_data)["_corrupt_record"] for r in got if r.error_type) == ["130,short", "131,short"]
        seen.append(sorted(got, key=lambda r: r.ingest_seq))
    assert seen[0] == seen[1] == seen[2]


def test_the_last_file_wins_and_quarantine_ids_are_stable(spark, tmpdir_path, splits):
    from contactlake.operators.core import dedupe_latest
    from contactlake.sources.sinks import quarantine_rows, relational_upsert_rows
    one = '{"id":"9","properties":{"email":"x@b.com","annualrevenue":"%d"}}'
    folder = landed(os.path.join(tmpdir_path, "in"), {
        "a.json": "\n".join(['{"id":"1", bad'] * 200 + [one % 111]), "b.json": one % 222})
    ids = []
    for size in (100, 1 << 20):
        splits(size)
        annotated = validate_api(readers.read_api_contacts(spark, folder))
        valid = annotated.where("error_type IS NULL").withColumn("processed_at", F.lit("2024-01-01").cast("timestamp"))
        assert [r.annual_revenue for r in dedupe_latest(valid).collect()] == [222]
        assert relational_upsert_rows(None, valid).count() == 1
        bad = annotated.where("error_type IS NOT NULL")
        ids.append(sorted(r.id for r in quarantine_rows(bad, "r1", "2024-01-01").collect()))
    assert ids[0] == ids[1] and len(set(ids[0])) == 200


def test_records_over_the_limit_are_kept_as_lines(spark, tmpdir_path, splits, monkeypatch):
    monkeypatch.setattr(framing, "RECORD_BYTES", 40)
    text = '{"id":"1",\n"properties":{"email":"' + "a" * 50 + '"}}\n{"id":"2"}\n{"id":\n"3"}\n'
    want = ['{"id":"1",', '"properties":{"email":"' + "a" * 50 + '"}}', '{"id":"2"}', '{"id":\n"3"}']
    assert [d for _, _, d in frame(text, "json")] == want
    assert [d for _, _, d in frame(text, "json", [1])] == want


def test_text_that_is_no_utf8_and_no_text(spark, tmpdir_path):
    folder = landed(os.path.join(tmpdir_path, "in"), {"e.json": "", "b.json": "\n \n"})
    with open(os.path.join(folder, "x.json"), "wb") as fh:
        fh.write(b'{"id":"1","properties":{"email":"\xff"}}\n')
    assert [r.id for r in readers.read_api_contacts(spark, folder).collect()] == ["1"]
