"""Every operator on nulls, empty and long texts, ties, repeated rows and clashing columns."""

import pytest

import corpus_pipeline
from ordermill.llm import (decontaminate, langid, mixing, neardup, quality, sharding, tokencount,
                           toxicity, urlfilter, warc)
from ordermill.llm.queries import TOKENIZERS

PROSE = "the quick brown fox jumps over the lazy dog and then it sleeps under a tall tree"
LONG = " ".join(f"word{i % 977} und{i % 13}" for i in range(200_000))
DOCUMENTS = [
    (1, PROSE, "en", "a"), (1, PROSE, "en", "a"), (2, PROSE, "en", "b"), (3, "", "en", "a"),
    (4, None, None, None), (None, PROSE + " once more", "de", "a"), (None, None, None, None),
    (None, PROSE + " once more", "de", "a"), (5, LONG, "de", None), (6, " \n\t\x0b ", None, "b"),
    (7, "x", None, "a"), (8, "\n".join([PROSE] * 30), "en", "\U0001f600"), (9, "été ñ 漢字", "fr", "é"),
    (1, "another text with the same id as the first one", None, "a"), (10, "12345 !!!", "en", "b")]
# Names that the operators use themselves.
CLASHES = ["row", "n_words", "kept", "size", "key", "text_1", "root", "score", "shard", "slot",
           "hash", "lines", "bucket", "place", "class", "copies", "target", "weight", "item"]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          + ", ".join(f"{c} string" for c in CLASHES))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(
        [(*r, len(r[1]) if r[1] is not None else None, *CLASHES) for r in DOCUMENTS], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (1, 0, 1), (2, None, 0), (3, 1, None), (None, 1, 1), (5, 0, 0), (8, 1, 1),
         (99, 1, 1), (8, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, PROSE), (1, PROSE), (2, "x"), (3, None), (4, ""), (None, PROSE), (5, "!!!"),
         (6, " ".join(f"word{i}" for i in range(50)))], "item_id long, text string")


def rows(table):
    return sorted((tuple(r) for r in table.collect()), key=repr)


def test_near_duplicates(documents):
    found = rows(neardup.near_duplicates(documents))
    assert len(found) == len(DOCUMENTS)
    of = {}
    for doc_id, n, component, kept in found:
        of.setdefault(doc_id, []).append((n, component, kept))
    assert of[1] == [(1, 1, True) if n == 1 else (n, 1, True) for n, _, _ in of[1]]
    assert of[2][0][1:] == (1, False)
    assert of[3] == [(0, 3, True)] and of[4] == [(0, 4, True)] and of[6] == [(0, 6, True)]
    assert (0, None, False) in of[None] and of[7] == [(1, 7, True)]


def test_one_of_each_group(documents):
    kept = neardup.one_of_each_group(documents)
    assert kept.columns == documents.columns
    ids = [r[0] for r in rows(kept.select("doc_id", "text"))]
    assert ids.count(1) == 2  # two texts, one of them there twice
    assert 2 not in ids and {3, 4, 5, 6, 7, 8, 9, 10} <= set(ids)


def test_quality(documents):
    found = [r.asDict() for r in quality.judge(documents.drop("n_words", "kept", "lines", "hash")).collect()]
    assert len(found) == len(DOCUMENTS)
    one = {r["doc_id"]: r for r in found}
    assert one[4]["n_words"] == 0 and not one[4]["kept"] and one[4]["base_failed"]
    assert one[8]["n_dup_lines"] == 29 and one[8]["n_repeat_words"] == 17 * 30
    assert one[5]["n_words"] == 400_000 and one[5]["base_failed"]
    assert len(quality.judge(documents).collect()) == len(DOCUMENTS)
    assert quality.clean(documents).columns == documents.columns


def test_mixing(documents, labels):
    weights = mixing.quality_weights(labels)
    found = [r.asDict() for r in mixing.shares(documents, weights).collect()]
    assert len(found) == len(DOCUMENTS)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    assert {r["source"]: r["source_size"] for r in found}[None] == 400_000
    again = rows(mixing.shares(documents, weights))
    assert again == rows(mixing.shares(documents.repartition(5), weights))
    mixed = mixing.mixed(documents, weights)
    assert mixed.columns == documents.columns
    assert mixed.count() == sum(r["taken"] // r["size"] if r["size"] else r["copies"] for r in found)


def test_decontaminate(documents, benchmark):
    found = {}
    for r in decontaminate.judge(documents, benchmark).collect():
        found.setdefault(r["row"]["doc_id"], []).append((r["n_words"], r["n_hit"], r["items"]))
    assert sum(map(len, found.values())) == len(DOCUMENTS)
    assert sorted(found[1]) == sorted([(17, 17, ["1"]), (17, 17, ["1"]), (10, 0, [])])
    assert found[4] == [(0, 0, [])] and found[7] == [(1, 1, ["2"])]
    assert found[8] == [(17 * 30, 17 * 30, ["1"])]
    left = decontaminate.without_contaminated(documents, benchmark)
    assert left.columns == documents.columns and left.where("doc_id = 2").isEmpty()


def test_sharding(documents):
    found = sharding.sharded(documents, shards=4).collect()
    assert len(found) == len(DOCUMENTS)
    assert sorted((r["shard"], r["slot"]) for r in found) == [
        (s, i) for s in range(4) for i in range(4 if s < 3 else 3)]


def test_language(documents):
    found = rows(langid.predict(documents, langid.fit(documents)))
    assert len(found) == len(DOCUMENTS)
    assert {r[1] for r in found if r[0] in (4, 3, 6, 10)} == {"und"}
    assert langid.fit(documents.where("lang = 'xx'")) is None
    assert {r[1] for r in rows(langid.predict(documents, None))} == {"und"}


def test_toxicity(documents, labels):
    model = toxicity.fit(documents, labels)
    found = rows(toxicity.score(documents, model))
    assert len(found) == len(DOCUMENTS) and all(0 <= r[1] <= 1 for r in found)
    assert toxicity.fit(documents, labels.where("toxic = 0")) is None
    assert {r[1] for r in rows(toxicity.score(documents, None))} == {0.0}


def test_token_counts(documents):
    vocabulary = tokencount.load_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model")
    found = rows(tokencount.count_tokens(documents, vocabulary))
    assert len(found) == len(DOCUMENTS)
    assert {r for r in found if r[0] in (3, 4)} == {(3, 0), (4, 0)}


def test_warc(spark):
    schema = "page_id long, url string, html string, digest string, first string"
    big, small = "<p>" + "é" * 60, "tiny"
    pages = spark.createDataFrame(
        [(i, u, h, "d", "f") for i, u, h in [
            (3, "http://a/1", big), (2, None, big), (2, "http://a/2 x\r\ny", big), (None, "u", big),
            (4, "u", small), (5, "u", small), (6, "u", None), (None, "u", "z" * 200),
            (None, "u", "z" * 200), (7, "u", LONG)]], schema)
    names, folder = warc.write_archives(pages)
    found = warc.read_archives(names, folder).collect()
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"])
                  for r in found), key=repr)
    assert got == sorted([
        (3, "revisit", 2, 123), (2, "response", None, 123), (2, "response", None, 123),
        (None, "revisit", 2, 123), (4, "response", None, 4), (5, "response", None, 4),
        (6, "response", None, 0), (None, "response", None, 200), (None, "response", None, 200),
        (7, "response", None, len(LONG))], key=repr)


def test_url_filter(spark, labels):
    schema = "page_id long, url string, host string, path string, form string, verdict string"
    urls = [(1, "HTTP://WWW.Example.COM/en/1"), (2, "https://x.net/es/2?q"), (2, "https://x.net/es/2?q"),
            (3, None), (None, "no address"), (4, "http://"), (5, "http://evilnet/es/"),
            (6, "http://a.example.com#frag/en/"), (7, "http://h/" + "s/" * 50_000)]
    pages = spark.createDataFrame([(i, u, "h", "p", "f", "v") for i, u in urls], schema)
    found = urlfilter.judge(pages, urlfilter.bad_pages(labels)).collect()
    assert len(found) == len(urls)
    one = {r["page_id"]: tuple(r)[1:] for r in found}
    assert one[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert one[2] == ("x.net", "/es/2", "net/es/", "block")
    assert one[3] == ("", "", None, "allow") and one[5][2] is None and one[6] == (
        "a.example.com", "", None, "allow")


def test_empty_tables(spark, documents, labels, benchmark):
    empty, no_labels, no_items = documents.limit(0), labels.limit(0), benchmark.limit(0)
    vocabulary = tokencount.Vocabulary((("▁a", -1.0), ("<unk>", -2.0)), False)
    for table in (neardup.near_duplicates(empty), neardup.one_of_each_group(empty),
                  quality.judge(empty), quality.clean(empty), mixing.shares(empty),
                  mixing.mixed(empty), decontaminate.judge(empty, benchmark),
                  sharding.sharded(empty), langid.predict(empty, langid.fit(empty)),
                  toxicity.score(empty, toxicity.fit(empty, no_labels)),
                  tokencount.count_tokens(empty, vocabulary)):
        assert table.count() == 0
    assert decontaminate.judge(documents, no_items).where("contaminated").count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(*warc.write_archives(pages)).count() == 0
    assert urlfilter.judge(pages, urlfilter.bad_pages(no_labels)).count() == 0


def test_pipeline_stages_keep_the_columns(spark, documents, benchmark, labels, tmp_path):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, str(tmp_path)).columns == documents.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
