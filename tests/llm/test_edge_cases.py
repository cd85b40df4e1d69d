"""Every operator on awkward rows, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

from comanda.llm import (
    decontaminate, license_scan, lm_scoring, mixing, pii, quality_rules, secret_scan, simhash_dedup, suffix_dedup, toxicity,
)


def operators(spark, labels):
    known = license_scan.known_sentences(spark)
    items = spark.createDataFrame(
        [(1, "brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, "one"), (4, "two words"), (None, "other words stand here")],
        "item_id long, text string")
    return {
        "toxicity": lambda d: toxicity.score(d, labels),
        "quality": lambda d: quality_rules.judge(d, labels),
        "license": lambda d: license_scan.recognise(d, known),
        "mixing": lambda d: mixing.mix(d, labels),
        "secrets": lambda d: secret_scan.scan(d, spans_col="found"),
        "simhash": simhash_dedup.near_duplicates,
        "decontaminate": lambda d: decontaminate.find(d, items),
        "pii": pii.scan,
        "suffix": suffix_dedup.remove,
        "lm": lm_scoring.score,
    }


ROW_WISE = {"toxicity", "quality", "mixing", "secrets", "simhash", "pii", "suffix", "lm"}
NAMES = sorted(ROW_WISE | {"license", "decontaminate"})


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows(spark, awkward, clashing, odd_labels, name):
    run = operators(spark, odd_labels)[name]
    plain = run(awkward).collect()
    if name in ROW_WISE:
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in plain) == sorted(
            (r["doc_id"] is None, r["doc_id"] or 0) for r in awkward.select("doc_id").collect())
    also = run(clashing).collect()
    assert len(also) == len(plain)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, nothing, no_labels, name):
    assert operators(spark, no_labels)[name](nothing).collect() == []


def test_filters_on_empty_tables(spark, nothing, no_labels):
    items = spark.createDataFrame([], "item_id long, text string")
    for kept in (quality_rules.keep_good(nothing, no_labels), simhash_dedup.deduplicate(nothing),
                 decontaminate.decontaminate(nothing, items), secret_scan.mask(nothing)):
        assert kept.collect() == [] and kept.columns == nothing.columns


def test_kept_rows_have_their_own_columns(clashing, odd_labels):
    """Rows that share an id, or have none, are judged each on their own; other columns pass, whatever their names."""
    kept = quality_rules.keep_good(clashing, odd_labels)
    assert kept.columns == clashing.columns
    judged = quality_rules.judge(clashing, odd_labels)
    assert kept.count() == judged.filter("kept").count()


@pytest.mark.parametrize("name", ["quality", "mixing", "toxicity"])
def test_no_labels(spark, awkward, no_labels, name):
    assert operators(spark, no_labels)[name](awkward).count() == 12


def test_values_of_awkward_rows(spark, awkward, no_labels, odd_labels):
    by = lambda df, *c: {r["doc_id"]: tuple(r[x] for x in c) for r in df.collect()}
    fingerprints = by(simhash_dedup.near_duplicates(awkward), "fingerprint", "component_id")
    assert fingerprints[2] == fingerprints[3] == fingerprints[4] == ("0" * 16, 2)
    assert fingerprints[6][1] == 1
    kept = simhash_dedup.deduplicate(awkward)
    assert kept.columns == awkward.columns
    assert kept.filter("doc_id in (1, 2, 3, 4, 6)").select("doc_id").collect() == [(1,), (2,)]
    counts = by(quality_rules.judge(awkward, no_labels), "n_words", "n_repeat_words", "base_failed", "kept")
    assert counts[2] == counts[3] == counts[4] == (0, 0, True, False)
    assert counts[5] == (20_000, 20_000, True, False)
    rest = by(suffix_dedup.remove(awkward), "n_bytes", "n_removed", "n_spans")
    assert rest[2] == rest[3] == (0, 0, 0) and rest[1] == (77, 0, 0) and rest[6] == (77, 77, 1)
    assert rest[5][1] == 0  # its own repeats are not in an earlier document
    scores = by(lm_scoring.score(awkward), "n_tokens", "held_out")
    assert scores[2][0] == scores[3][0] == scores[4][0] == 1 and scores[5][0] == 20_001
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find(awkward, spark.createDataFrame(
        [(1, "brown fox jumps over the lazy dog"), (2, None), (4, "one")], "item_id long, text string")).collect()}
    assert found == {(1, 1), (6, 1), (None, 1), (7, 4)}
    rates = by(mixing.mix(awkward, odd_labels), "n_tokens", "rate")
    assert rates[2] == rates[3] and rates[2][0] == 0
    assert all(r["toxicity"] == 0.5 for r in toxicity.score(awkward, no_labels).collect())


def test_hot_group_of_copies(spark):
    """A third of all rows are one text, another tenth near copies of it."""
    base = " ".join(f"word{i}" for i in range(60))
    rows = [(i, base if i % 3 == 0 else " ".join(f"v{i}x{j * 7919 % 1009}" for j in range(40))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = simhash_dedup.near_duplicates(docs).filter(F.col("doc_id") % 3 == 0).select("component_id").distinct().collect()
    assert classes == [(0,)]
    removed = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove(docs).collect()}
    assert removed[0] == 0 and all(removed[i] == len(base) for i in range(3, 300, 3))
