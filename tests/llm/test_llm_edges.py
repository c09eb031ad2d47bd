"""Every operator and stage on nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfpulse.llm import bpe, counts, decontamination, jaccard, language, neighbours, secrets, substrings, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, row long, spans string"
LONG = " ".join(f"word{n} or{n % 97}" for n in range(30_000))
TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog near the river bank"), (2, None), (3, ""), (4, "   \n"),
    (5, LONG), (6, LONG), (1, "the quick brown fox jumps over the lazy dog near the river bank"),
    (1, "another text under the same id, with password = 'abcdefghijkl12345' in it"), (None, "no id at all, ça va, 日本語"),
    (None, None), (7, "!!! ??? 123"), (8, "a" * 5000), (9, "word"), (10, "token: " + "f" * 40 + " AKIA" + "Q" * 20),
]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, "en" if n % 3 else None, "s", len(t or ""), 0.5, "k", n, "x") for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, "word"), (5, LONG)],
                                 "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 1, 1), (None, 1, 1), (6, None, None), (5, 0, 0), (99, 1, 1)],
                                 "doc_id long, quality int, toxic int")


def empty(frame):
    return frame.where("1 = 0")


def ids(frame):
    return sorted((row["doc_id"] for row in frame.collect()), key=str)


ALL = sorted((i for i, _ in TEXTS), key=str)


def test_substrings(documents):
    rows = substrings.without_repeats(documents, kept=True).collect()
    assert ids(substrings.without_repeats(documents)) == ALL
    by_size = {(r["doc_id"], r["n_bytes"]): r for r in rows}
    assert by_size[5, len(LONG)]["n_removed"] == len(LONG) and by_size[5, len(LONG)]["kept"] == b""
    assert by_size[8, 5000]["n_removed"] == 5000 and by_size[8, 5000]["n_spans"] == 1
    assert by_size[2, 0]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by_size[1, 63]["n_removed"] == 0  # copies, but shorter than 200 bytes
    assert substrings.without_repeats(empty(documents)).count() == 0


def test_toxicity(documents, labels):
    model = toxicity.fit(documents, labels)
    rows = toxicity.score(documents, model).collect()
    assert ids(toxicity.score(documents, model)) == ALL
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    none = toxicity.fit(documents, empty(labels))
    assert all(r["score"] < 1e-9 for r in toxicity.score(documents, none).collect())
    assert toxicity.score(empty(documents), toxicity.fit(empty(documents), labels)).count() == 0


def test_neighbours(spark):
    big = 1e300
    rows = [(n, [float(n), 1.0]) for n in range(1, 40)] + [(40, None), (41, [0.0, 0.0]), (42, [float("nan"), 1.0]), (43, [None, 1.0]),
            (44, [float("inf"), 1.0]), (None, [1.0, 1.0]), (45, [1.0, 2.0, 3.0]), (5, [5.0, 1.0]), (46, [39.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(big)).withColumn("rank", F.lit(1))
    found = neighbours.nearest_rows(table, table.where("vec_id % 5 = 0 or vec_id = 46"), 3).collect()
    by_query = {}
    for row in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(row["query_id"], []).append(row["vec_id"])
    assert by_query[5] == [39, 46, 38] and by_query[46] == [39, 38, 37]  # ties by id, own row left out
    assert 40 not in by_query and 45 not in by_query  # no part; no other of its dimension
    assert neighbours.nearest_rows(empty(table), empty(table), 3).count() == 0
    assert neighbours.nearest_rows(table, empty(table), 3).count() == 0


def test_secrets(spark, documents, tmp_path):
    versions = secrets.address(documents)
    found = secrets.digest(secrets.findings(versions, secrets.update_ledger(versions, f"{tmp_path}/ledger")))
    assert ids(found) == ALL
    spans = {(r["doc_id"], r["spans"]) for r in found.collect()}
    assert (10, "assign:0:47,hex:7:47,access:48:72") in spans and (2, "") in spans
    assert secrets.digest(secrets.findings(empty(versions), secrets.update_ledger(empty(versions), f"{tmp_path}/none"))).count() == 0
    clean = secrets.redact(documents, f"{tmp_path}/ledger")
    assert clean.columns == documents.columns and clean.count() == len(TEXTS)
    assert {r["text"] for r in clean.where("doc_id = 10").collect()} == {"[secret] [secret]"}
    assert secrets.redact(empty(documents), f"{tmp_path}/ledger").count() == 0
    taken = documents.select("*", *(F.lit(n).alias(name) for n, name in enumerate(("blob", "row", "__blob", "path")) if name != "row"))
    kept = secrets.redact(taken, f"{tmp_path}/ledger")
    assert kept.columns == taken.columns and {(r["blob"], r["__blob"], r["path"]) for r in kept.collect()} == {(0, 2, 3)}


def test_secrets_many_in_one_text(spark, tmp_path):
    count, one = 100_000, "é token=abcdefghijkl12345 "
    frame = spark.createDataFrame([(1, one * count, 0)], "doc_id long, text string, n_chars long")
    versions = secrets.address(frame)
    row = secrets.digest(secrets.findings(versions, secrets.update_ledger(versions, f"{tmp_path}/ledger"))).first()
    spans = [f"assign:{len(one) * n + 2}:{len(one) * (n + 1) - 1}" for n in range(count)]
    assert row["n_assign"] == count and row["spans"] == ",".join(spans)
    clean = secrets.redact(frame, f"{tmp_path}/ledger").first()
    assert clean["text"] == "é [secret] " * count and clean["n_chars"] == 11 * count


def test_bpe(documents):
    path = bpe.vocabulary_path()
    assert ids(bpe.codec_digest(documents, path)) == ALL
    encoded = bpe.encode(documents.withColumnRenamed("key", "ids2"), path, keep=("doc_id", "row", "text"))
    back = bpe.decode(encoded.drop("text"), path, keep=("doc_id", "row"))
    texts = {r["row"]: r["text"] or "" for r in documents.collect()}
    assert {r["row"]: r["text"] for r in back.collect()} == texts
    assert bpe.codec_digest(empty(documents), path).count() == 0


def test_decontamination(documents, benchmark):
    pairs = {(r["doc_id"], r["item_id"]) for r in decontamination.contained(documents, benchmark).collect()}
    assert pairs == {(1, 1), (5, 5), (6, 5), (9, 4)}
    left = decontamination.decontaminate(documents, benchmark)
    assert left.columns == documents.columns and left.count() == len(TEXTS) - 5
    assert decontamination.decontaminate(documents, empty(benchmark)).count() == len(TEXTS)
    assert decontamination.contained(documents, empty(benchmark)).count() == 0
    assert decontamination.contained(empty(documents), benchmark).count() == 0


def test_language(documents):
    net = language.fit(documents)
    rows = language.identify(documents, net).collect()
    assert ids(language.identify(documents, net)) == ALL
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 4, 7)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert language.accepted(documents, net).columns == documents.columns
    assert language.fit(empty(documents)) is None
    assert {r["lang_pred"] for r in language.identify(documents, None).collect()} == {"und"}
    assert language.identify(empty(documents), net).count() == 0


def test_warc(spark):
    nasty = [(1, "http://a.example/x y\nz", "same"), (2, None, "same"), (3, "not a url", None), (4, "http://[bad", ""), (None, "http://b.example", "same"),
             (5, "HTTP://WWW.Example.COM:80/p?q=1#f", "é" * 100_000), (5, "http://www.example.com/p?q=1", "é" * 100_000), (2, None, "same")]
    pages = spark.createDataFrame(nasty, "page_id long, url string, html string").withColumn("file", F.lit("x")).withColumn("key", F.lit(1))
    rows = warc.read_archive(*warc.archive(pages)).collect()
    told = sorted((r["page_id"], r["record_type"], r["payload_bytes"], r["refers_to"]) for r in rows if r["page_id"] is not None)
    assert told == sorted([(1, "revisit", 4, 2), (2, "response", 4, None), (2, "response", 4, None), (3, "revisit", 0, 4), (4, "response", 0, None),
                           (5, "response", 200_000, None), (5, "response", 200_000, None)], key=str)
    assert [r["record_type"] for r in rows if r["page_id"] is None] == ["response"]
    directory, folder = warc.archive(pages)
    asked = spark.createDataFrame([("http://www.example.com/p?q=1",), ("http://a.example/x y\nz",), ("http://nowhere.example/",), (None,)], "url string")
    hits = sorted((r["url"] or "", r["page_id"]) for r in warc.look_up(asked, directory, folder).collect())
    assert hits == [("", 2), ("", 2), ("http://a.example/x y\nz", 1), ("http://www.example.com/p?q=1", 5), ("http://www.example.com/p?q=1", 5)]
    assert warc.read_archive(*warc.archive(empty(pages))).count() == 0


def test_warc_query_looks_up_each_block_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    monkeypatch.setattr(warc, "read_archive", None)  # the query searches, it does not read in turn
    pages = spark.createDataFrame(
        [(n, f"http://h{n % 40}.example/", f"text {n % 90}") for n in range(300)], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    assert sorted(r["page_id"] for r in warc.op8_warc_index(spark, str(tmp_path)).collect()) == list(range(300))
    directory, folder = warc.archive(pages)
    asked = spark.createDataFrame([("http://h3.example/",), ("http://h3.example/",), ("http://h39.example/",)], "url string")
    hits = sorted((r["url"], r["page_id"]) for r in warc.look_up(asked, directory, folder).collect())
    assert hits == sorted([("http://h3.example/", n) for n in range(3, 300, 40)] * 2 + [("http://h39.example/", n) for n in range(39, 300, 40)])


def test_warc_line_breaks_without_a_host(spark):
    urls = ["no\nhost", "no\r\n\thost", "\n"]
    pages = spark.createDataFrame([(n, url, f"text {n}") for n, url in enumerate(urls)], "page_id long, url string, html string")
    directory, folder = warc.archive(pages)
    assert sorted(r["page_id"] for r in warc.read_archive(directory, folder).collect()) == [0, 1, 2]
    assert sorted((r["url"], r["page_id"]) for r in warc.look_up(pages, directory, folder).collect()) == sorted(
        (url, n) for n, url in enumerate(urls))


def test_jaccard_keeps_columns_of_any_name(documents):
    names = {"__s": "lang", "seen": "source", "row": "row", "component": "key", "m.doc_id": "score"}
    frame = documents.select("doc_id", "text", *(F.col(f"`{old}`").alias(new) for new, old in names.items()))
    stay = jaccard.one_of_each(frame)
    assert stay.columns == frame.columns
    kept = {tuple(map(str, row)) for row in frame.collect()}
    assert all(tuple(map(str, row)) in kept for row in stay.collect())
    assert sorted(ids(stay), key=str) == sorted(ids(jaccard.one_of_each(documents)), key=str)


def test_jaccard(documents):
    rows = jaccard.join(documents).collect()
    assert ids(jaccard.join(documents)) == ALL
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[6]["class_id"] == 5 and by_id[5]["copies"] == 2 and by_id[2]["class_id"] == by_id[3]["class_id"] == 2
    stay = jaccard.one_of_each(documents)
    assert stay.columns == documents.columns
    assert sorted(r["doc_id"] for r in stay.where("text is not null and doc_id is not null").collect()) == [1, 1, 5, 7, 8, 9, 10]
    assert jaccard.join(empty(documents)).count() == 0 and jaccard.one_of_each(empty(documents)).count() == 0


def test_counts(documents):
    rows = counts.token_counts(documents, bpe.vocabulary_path()).collect()
    assert sorted((r["doc_id"] for r in rows), key=str) == ALL
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3)} == {0}
    assert counts.token_counts(empty(documents), bpe.vocabulary_path()).count() == 0


def test_pipeline_stages(spark, documents, benchmark, tmp_path):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for start in (documents, empty(documents)):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == documents.columns
        last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert all(row["same"] for row in last) and bool(last) == (start is documents)


def test_columns_called_as_the_operators_call_theirs(spark, documents, labels):
    """Kept columns come out as they went in."""
    names = ("doc_id", "text", "_text", "__text", "ids_", "TEXT_")
    taken = documents.select("doc_id", "text", *(F.lit(n).alias(name) for n, name in enumerate(names) if n > 1))
    net = language.fit(documents.where("text is null or length(text) < 1000").select("text", "lang"))
    results = (
        bpe.encode(taken, bpe.vocabulary_path(), keep=names), bpe.round_trip(taken, bpe.vocabulary_path(), keep=names),
        counts.token_counts(taken, bpe.vocabulary_path(), keep=names), language.identify(taken, net, keep=names),
        toxicity.score(taken, toxicity.fit(documents, labels), keep=names),
    )
    for result in results:
        rows = result.collect()
        assert result.columns[: len(names)] == list(names) and len(rows) == len(TEXTS)
        assert {tuple(r)[2: len(names)] for r in rows} == {(2, 3, 4, 5)}
        assert sorted(((r["doc_id"], r["text"]) for r in rows), key=str) == sorted(TEXTS, key=str)
    encoded = bpe.encode(documents, bpe.vocabulary_path()).withColumn("__ids", F.lit(7)).withColumn("_ids", F.lit(8))
    back = bpe.decode(encoded, bpe.vocabulary_path(), keep=("doc_id", "ids", "__ids", "_ids")).collect()
    assert {(r["__ids"], r["_ids"]) for r in back} == {(7, 8)}
    assert sorted(((r["doc_id"], r["text"]) for r in back), key=str) == sorted(((i, t or "") for i, t in TEXTS), key=str)
