"""The pipeline's stages on messy rows, and the queries beside their SQL."""

import pytest
from samples import prose

import corpus_pipeline
from foliozone.llm import simhash
from foliozone.llm.queries import ORACLES, QUERIES
from foliozone.llm.tables import text_key

SF = "/root/testdata/sf0.001"


def test_stages_take_and_return_documents(spark, messy, clashing, empty):
    for docs in (messy, clashing, empty):
        for name, step in corpus_pipeline.STAGES[:-1]:
            got = step(spark, docs, SF)
            assert got.columns == docs.columns and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema], name
            assert got.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_decisions_take_effect(spark):
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    clean = prose(1, 150)
    rows = [(1, clean), (2, clean + " tail"), (3, passage), (4, "12 34"), (5, "the password = s3cr3tvalue in " + prose(2, 150)), (6, prose(3, 150))]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF)
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
    assert set(kept["language ID"]) == {1, 2, 3, 5, 6}
    assert set(kept["SimHash near-dedup"]) == {1, 3, 5, 6}
    assert set(kept["benchmark decontamination"]) == {1, 5, 6}
    last = kept["secret scans"][5]
    assert "s3cr3tvalue" not in last["text"] and "[SECRET] in " in last["text"] and last["n_chars"] == len(last["text"])
    assert kept["secret scans"][1]["text"] == clean


def plain_first_of_each(rows):
    """Closes fingerprints that differ in few bits, all beside all, and keeps the smallest doc_id of each."""
    prints = {i: simhash.fingerprint((t or "").encode()) for i, t in rows}
    left, kept = set(prints), set()
    while left:
        group, queue = set(), [min(left)]
        while queue:
            at = queue.pop()
            near = {i for i in left if (prints[i] ^ prints[at]).bit_count() <= 4}
            left -= near
            group |= near
            queue += near
        kept.add(min(group))
    return kept


def test_near_duplicates_equal_the_plain_version(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for k in range(30):  # copies with a word changed here and there, from few bits apart to many
        words = prose(700 + k, 300, 3000).split()
        rows.append((100_000 + 10 * k, " ".join(words)))
        for j, every in enumerate((200, 100, 50, 20), 1):
            rows.append((100_000 + 10 * k + j, " ".join(f"z{k}z{i}" if i % every == every - 1 else w for i, w in enumerate(words))))
    kept = plain_first_of_each(rows)
    assert 0 < sum(i >= 100_000 and i % 10 > 0 for i in kept) < 120  # some copies are near enough, some are not
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()) == sorted(kept)


def test_large_groups_are_dealt_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "MOST", 7)
    rows = [(i, prose(1, 400, 3000) + f" tail{i}") for i in range(40)]
    kept = plain_first_of_each(rows)
    assert len(kept) < 5
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()} == kept


def test_run_ends_in_pieces(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 150 and rows.filter("n_pieces <> size(piece_ids) or n_pieces = 0").count() == 0


def test_the_last_stage_tells_whether_pieces_decode(spark, messy):
    rows = corpus_pipeline.STAGES[-1][1](spark, messy, SF)
    assert rows.count() == messy.count() and rows.filter("lossless is null or not lossless").count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    from compare import compare, connect

    assert compare(spark, connect(SF), QUERIES[name], ORACLES[name], SF).startswith("ok ")


def test_queries_carry_their_numbers():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


def test_text_keys_do_not_tell_null_from_empty(spark):
    assert spark.sql("select '' text union all select null").select(text_key()).distinct().count() == 1
