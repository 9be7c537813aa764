"""The fixity audit against hashing every record by hand."""

import hashlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from metricwin.llm import fixity
from metricwin.llm.oracle import FIXITY
from metricwin.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, digest string, pos string"


def record(page_id, url, html):
    body = (html or "").encode()
    head = (
        "WARC/1.1\r\nWARC-Type: resource\r\n"
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>\r\n"
        f"WARC-Target-URI: {url or ''}\r\nContent-Type: text/html\r\n"
        f"Content-Length: {len(body)}\r\n\r\n"
    )
    return head.encode() + body + b"\r\n\r\n"


def laid_out(rows, per_file):
    """(page_id, digest) -> (begin, end, digest, copies)."""
    files = {}
    for page_id, url, html, *_ in rows:
        data = record(page_id, url, html)
        place = None if page_id is None else page_id // per_file
        digest = hashlib.sha256(data).hexdigest()
        files.setdefault(place, Counter())[page_id or 0, digest, len(data), page_id] += 1
    out = {}
    for own in files.values():
        at = 0
        for (_, digest, size, page_id), copies in sorted(own.items(), key=lambda x: x[0][:3]):
            out[page_id, digest] = (at, at + size * copies, digest, copies)
            at += size * copies
    return out


def expected(a, b, per_file):
    x, y = laid_out(a, per_file), laid_out(b, per_file)
    none, by_id = (None,) * 4, {}
    for key in x.keys() | y.keys():
        p, q = x.get(key), y.get(key)
        if (p and p[3]) != (q and q[3]):
            by_id.setdefault(key[0], []).append((p, q))
    out = []
    for page_id, pairs in by_id.items():
        file = None if page_id is None else page_id // per_file
        ours = [p for p, _ in pairs if p]
        theirs = [q for _, q in pairs if q]
        if page_id is not None and len(pairs) == 2 and len(ours) == len(theirs) == 1:
            out.append((file, page_id, *ours[0], *theirs[0], "differs"))
            continue
        for p, q in pairs:
            status = "missing" if q is None else "extra" if p is None else "repeated"
            out.append((file, page_id, *(p or none), *(q or none), status))
    return out


ROWS = [
    (i, f"http://h/{i % 3}", f"<p>é {i}</p>" * (1 + i % 4), "own digest", "own pos")
    for i in range(150)
]
ODD = [(None, None, None, None, None), (None, "u", "x", None, None), (7, None, "", "d", "p")] * 2


def changed(rows, at, html):
    return [(*r[:2], html, *r[3:]) if r[0] == at else r for r in rows]


@pytest.mark.parametrize(
    "second",
    [
        ROWS,
        changed(ROWS, 77, "broken"),
        changed(changed(ROWS, 0, None), 149, "longer than it was before, by far"),
        [r for r in ROWS if r[0] != 149],
        [r for r in ROWS if r[0] != 40],
        [*ROWS, ROWS[40], (-3, "u", "x", "d", "p"), (-900, "u", "x", "d", "p"), (9000, "u", "x", "d", "p")],
        [*ROWS, *ODD],
        [*changed(ROWS, 30, "x" * 300_000), (30, "u", "y", "d", "p")],
        [],
    ],
    ids=["same", "one", "two", "last lost", "one lost", "repeated, added", "more", "very long", "empty"],
)
def test_audit(spark, second):
    fanout = 3 if len(second) % 2 else 16
    a = spark.createDataFrame(ROWS, PAGES)
    b = spark.createDataFrame(second, PAGES)
    got = [tuple(r) for r in fixity.compare(a, b, per_file=20, fanout=fanout).collect()]
    assert sorted(got, key=str) == sorted(expected(ROWS, second, 20), key=str)


def test_a_lost_record_is_one_row(spark):
    a = spark.createDataFrame(ROWS, PAGES)
    got = fixity.compare(a, a.where("page_id != 3"), per_file=1024).collect()
    assert [(r["page_id"], r["status"]) for r in got] == [(3, "missing")]


def test_records_of_one_id_or_none(spark):
    """Many different and many equal records of a hot id and of no id."""
    hot = [(i, "u", f"page {k % 300}", "d", "p") for i in (None, 5, -5) for k in range(400)]
    a = [*ROWS[:40], *hot]
    b = [r for k, r in enumerate(a) if k not in (2, 45, 46, 460, 900)] + [(None, "u", "new", "d", "p")]
    frames = [spark.createDataFrame(x, PAGES) for x in (a, b)]
    got = [tuple(r) for r in fixity.compare(*frames, per_file=16, fanout=4).collect()]
    assert sorted(got, key=str) == sorted(expected(a, b, 16), key=str)
    assert len(got) == 6


def test_empty_replicas_agree(spark):
    none = spark.createDataFrame([], PAGES)
    assert fixity.compare(none, none).collect() == []


def test_only_bad_branches_are_read(spark):
    """Frontiers hold the path to the damage and nothing else; there is one root."""
    odd = [*ROWS, (-40, "u", "x", None, None), (None, "u", "x", None, None)]
    a = fixity.manifest(spark.createDataFrame(odd, PAGES), 20)
    b = fixity.manifest(spark.createDataFrame([r for r in odd if r[0] != 77], PAGES), 20)
    ways = fixity.ways_up([a, b], 20, 4)
    one, two = (fixity.tree(m, ways) for m in (a, b))
    place = list(fixity.PLACE)
    for x, y in zip(one.levels, two.levels, strict=True):
        other = y.select(*place, F.col("hash").alias("other"))
        differing = x.join(other, place, "full_outer").where("not hash <=> other")
        assert differing.count() == 1
    assert one.levels[-1].count() == 1
    assert [(r["page_id"], r["status"]) for r in fixity.audit(one, two).collect()] == [(77, "missing")]


def test_root_is_the_hash_of_hashes(spark):
    m = fixity.manifest(spark.createDataFrame(ROWS[:20], PAGES), 20)
    tree = fixity.tree(m, fixity.ways_up([m], 20, 32))

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    leaves = [hashlib.sha256(record(*r[:3])).hexdigest() + "*1" for r in ROWS[:20]]
    file_root = sha("".join(sha(sha(sha(leaf))) for leaf in leaves))
    root = tree.levels[-1].first()
    assert root["hash"] == sha(file_root)
    assert (root["begin"], root["end"]) == (0, sum(len(record(*r[:3])) for r in ROWS[:20]))


def test_sql_agrees(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{folder}/pages.parquet'")
    want = con.sql(FIXITY)
    got = QUERIES["op2_merkle_fixity"](spark, folder)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = [tuple(r[c] for c in columns) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(want.select(*columns).fetchall(), key=str)
    statuses = {r["status"] for r in got.collect()}
    assert statuses == {"differs", "missing", "extra", "repeated"}
