"""Archives, paragraphs, decontamination and the pipeline: round trips, brute force, odd rows."""

import io
import random

import corpus_pipeline
from dragoman.llm import archives, decontaminate, paragraphs
from dragoman.llm.queries import QUERIES
from dragoman.session import shared_folder

SMALL = "/root/testdata/sf0.01"


def test_arc_versions_and_broken_records():
    for version in (1, 2):
        data = archives.arc_head(version)
        data += archives.arc_record({"url": "http://a b/", "ip": "1.2.3.4", "date": "20010203040506", "content_type": "text/html", "document": b"HTTP/1.0 200 OK\r\n\r\nbody\n"}, version)
        data += b"garbage line\n" + archives.arc_record({"url": None, "document": None}, version) + archives.arc_record({"url": "x", "document": b"12345"}, version)[:-3]
        got = list(map(archives.converted, archives.parse_arc(io.BytesIO(data))))
        assert [r["problem"] for r in got] == [None, "no header line", None, "ends early"]
        assert got[0]["target_uri"] == "http://a%20b/" and got[0]["date"] == "2001-02-03T04:05:06Z" and got[0]["payload"] == b"body\n" and got[0]["record_type"] == "response"
        assert got[2]["payload_digest"] == "da39a3ee5e6b4b0d3255bfef95601890afd80709"


def test_pages_round_trip_with_revisits(spark):
    big = "ü" * 600
    rows = [(1, "u", big, 1), (2, None, big, 1), (3, "u", "small", 1), (4, "u", "small", 1), (5, "u", None, 1), (None, "u", "no id", 1), (7, "u", "WARC/1.1\r\n\r\nfiledesc:// \n" * 60, 1), (7, "u", "again", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type int")
    for version in (1, 2):
        got = archives.archived(spark, pages, version).collect()
        seen = {(archives_id(r), r.record_type, r.payload_bytes, None if r.payload is None else bytes(r.payload).decode()) for r in got}
        assert len(got) == 8 and all(r.problem is None for r in got)
        assert seen == {(1, "revisit", 1200, None), (2, "response", 1200, big), (3, "response", 5, "small"), (4, "response", 5, "small"), (5, "response", 0, ""),
                        (None, "response", 5, "no id"), (7, "response", len(rows[6][2]), rows[6][2]), (7, "response", 5, "again")}
        assert {r.refers_to_id for r in got if r.record_type == "revisit"} == {r.record_id for r in got if archives_id(r) == 2}


def archives_id(record):
    found = [x for x in record.http_headers.split("\r\n") if x.startswith("X-Page-Id: ")]
    return int(found[0][11:]) if found else None


def test_empty_pages(spark):
    assert archives.archived(spark, spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
    folder = shared_folder(spark, "arc-test")
    archives.write_arc(spark.createDataFrame([("a", "1.1.1.1", "20200101000000", "t", bytearray(b"\xff\x00\x80"))], "url string, ip string, date string, content_type string, document binary"), folder, 2)
    assert bytes(archives.convert_arc(spark, folder).first().payload) == b"\xff\x00\x80"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_repeated_passages_and_near_paragraphs(spark, odd_docs, no_docs):
    rng = random.Random(8)
    passage, paragraph, short = words(rng, 51), words(rng, 120), words(rng, 30)
    texts = [words(rng, 40) + " " + passage + " " + words(rng, 30), words(rng, 3) + " " + passage, paragraph, "intro line\n" + paragraph.replace(" ", " changed ", 1) + "\nend",
             short, short, words(rng, 200), None, ""]
    docs = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)] + [(6, texts[6], 0), (None, passage, 0)], "doc_id long, text string, start int")
    got = paragraphs.duplicates(spark, docs).collect()
    assert {(r.doc_id, r.kept_doc_id) for r in got} == {(1, 0), (3, 2)}
    assert all(0 <= r.start < r.end <= len(texts[r.doc_id]) for r in got)
    assert texts[3][[r for r in got if r.doc_id == 3][0].start:][:7] == paragraph.replace(" ", " changed ", 1)[:7]
    assert paragraphs.duplicates(spark, odd_docs).collect() == [] and paragraphs.duplicates(spark, no_docs).collect() == []


def test_winnowed_runs_cover_every_passage():
    rng = random.Random(9)
    for _ in range(60):
        passage = words(rng, 51)
        keys = []
        for _ in range(2):
            hashes = paragraphs.word_spans(words(rng, rng.randint(0, 40)) + " " + passage + " " + words(rng, rng.randint(0, 40)))[0]
            at = paragraphs.anchors(hashes)
            keys.append(set(paragraphs._runs(hashes, at, at + paragraphs.RUN_WORDS, paragraphs._WORDS).tolist()))
        assert keys[0] & keys[1]
    bands, rows = paragraphs.tuned_bands(0.8, 0.99)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.99


def brute_edits(item, text):
    """Least edit distance of the item to any passage of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(row[j - 1] + (c != d), row[j] + 1, now[-1] + 1))
        row = now
    return min(row)


def test_leaks_within_the_budget_are_found(spark, odd_docs, no_docs):
    rng = random.Random(10)
    items = [(k, words(rng, 24)) for k in range(8)]
    docs, want = [], set()
    for k in range(40):
        item, text = rng.choice(items)
        text = list(text.upper() if k % 3 == 0 else text.replace(" ", "  \n", 3))
        for _ in range(k % 9):
            at = rng.randrange(len(text))
            text[at:at + rng.randint(0, 1)] = rng.choice(["", "q", "z"])
        whole = words(rng, 30) + " " + "".join(text) + " " + words(rng, 30)
        docs.append((k, whole))
        norm = lambda t: " ".join(t.lower().split())
        edits = brute_edits(norm(items[item][1]), norm(whole))
        if edits <= int(decontaminate.EDIT_RATE * len(norm(items[item][1]))):
            want.add((k, item, edits))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items + [(99, None), (None, "no id at all in this item, which is long enough")], "item_id long, text string")
    for block in (1 << 20, 300):
        assert {(r.doc_id, r.item_id, r.edits) for r in decontaminate.leaks(spark, table, bench, block_chars=block).collect()} == want
    kept = decontaminate.clean(spark, table, bench)
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in docs} - {k for k, _, _ in want}
    assert decontaminate.leaks(spark, odd_docs, bench).collect() == [] and decontaminate.clean(spark, odd_docs, bench).count() == 8
    assert decontaminate.leaks(spark, no_docs, bench).collect() == [] and decontaminate.leaks(spark, table, bench.limit(0)).collect() == []


def test_leaks_equal_plain_search(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op9_decontaminate"](spark, SMALL).collect()}
    assert got >= {(d, i) for d, t in docs.items() for i, u in items.items() if t and u in t}


def test_pipeline_stages(spark, odd_docs, no_docs):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    for docs in (odd_docs, no_docs, documents):
        before = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, before, SMALL)
            assert after.columns == docs.columns
            before = spark.createDataFrame(after.collect(), docs.schema)
        tokens = corpus_pipeline.tokenise(spark, before, SMALL)
        assert tokens.count() == before.count() and tokens.filter("not exact").count() == 0
    texts = {r.text for r in before.collect()}
    assert len(texts) == before.count() > 700
