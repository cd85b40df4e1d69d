"""Short benchmark items inside long documents: size-partitioned MinHash containment, in DataFrame functions only.

Containment of an item in a document is |S(item) and S(document)| / |S(item)| over distinct shingles of five words. An
item of n shingles with containment of at least t shares at least ceil(t n) of them, so any n - ceil(t n) + 1 of its
shingles hold a shared one. The items are therefore partitioned by size, and each keeps its bottom-k MinHash sketch with
the k its size asks for. A document is probed with its own hashes up to the largest of each partition's sketches. This
finds every pair, whatever the document's length; what it finds is verified on the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.llm.text import fresh, small
from comanda.session import cut_lineage

WIDTH = 5
PERCENT = 80  # containment of at least this


def _tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _shingles(words: Column, width: int, hashed: bool) -> Column:
    """Distinct shingles of ``width`` words, as hashes or joined by spaces; none if there are fewer words."""
    def at(i: Column) -> Column:
        parts = [F.get(words, i + j) for j in range(width)]
        return F.xxhash64(F.lit(width), *parts) if hashed else F.concat_ws(" ", *parts)

    all_of = F.transform(F.sequence(F.lit(0), F.size(words) - width), at)
    return F.when(F.size(words) >= width, F.array_distinct(all_of)).otherwise(
        F.array().cast("array<bigint>" if hashed else "array<string>"))


def item_shingles(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, width, n, words) of the items that have words. One with fewer than five words is a single shingle."""
    words = items.select(F.col(id_col).alias("item"), _tokens(F.col(text_col)).alias("words")).filter(F.size("words") > 0)
    return words.withColumn("width", F.least(F.lit(WIDTH), F.size("words")))


def _up_to(hashes: Column, most: int) -> Column:
    return F.filter(hashes, lambda h: h <= most)


def _by_width(words: Column, width: Column, widths: Sequence[int], hashed: bool) -> Column:
    out = F.array().cast("array<bigint>" if hashed else "array<string>")
    for w in widths:
        out = F.when(width == w, _shingles(words, w, hashed)).otherwise(out)
    return out


def find(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, item_id, shared, item_shingles): every item that a document contains.

    A document is an id with a text: repeated rows count once, rows with a null id are told apart by their text. Null
    and empty texts contain nothing, items without words are in nothing; either table may be empty. Items that repeat
    an id are one row each and merged in the result.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        F.col(text_col).alias("_text"))
    wanted = cut_lineage(item_shingles(items, item_id, item_text).withColumn("row", F.monotonically_increasing_id()))
    widths = sorted(r[0] for r in wanted.select("width").distinct().collect())  # five values at most

    hashes = wanted.select("row", "width", _by_width(F.col("words"), F.col("width"), widths, True).alias("h"))
    needed = F.ceil(F.size("h") * F.lit(percent) / 100).cast("int")
    sketch = cut_lineage(hashes.select(
        "row", "width", F.floor(F.log2(F.size("h"))).cast("int").alias("size_class"),
        F.slice(F.sort_array("h"), F.lit(1), F.size("h") - needed + 1).alias("kept")))
    bounds = {r["width"]: r["most"] for r in sketch.groupBy("width", "size_class").agg(
        F.max(F.element_at("kept", -1)).alias("most")).groupBy("width").agg(F.max("most").alias("most")).collect()}
    keys = cut_lineage(sketch.select("row", F.explode("kept").alias("h")).groupBy("h").agg(
        F.collect_list("row").alias("rows")))
    key_rows = keys.count()

    words = plain.select("doc_id", "text_hash", _tokens(F.col("_text")).alias("words"))
    probes = [_up_to(_shingles(F.col("words"), w, True), bounds[w]) for w in widths]
    probe = F.concat(*probes) if probes else F.array().cast("array<bigint>")
    hits = words.select("doc_id", "text_hash", F.explode(probe).alias("h")).join(small(keys, key_rows), "h")
    candidates = cut_lineage(hits.select(
        "doc_id", "text_hash", F.explode("rows").alias("row")).distinct())
    suspects = candidates.select("doc_id", "text_hash").distinct()
    suspects = small(suspects, suspects.count())

    same = [plain["doc_id"].eqNullSafe(suspects["doc_id"]), plain["text_hash"] == suspects["text_hash"]]
    again = plain.join(suspects, same, "left_semi").dropDuplicates(["doc_id", "text_hash"])
    texts = wanted.select("row", "item", _by_width(F.col("words"), F.col("width"), widths, False).alias("s"))
    item_keys = cut_lineage(texts.select(
        "row", "item", F.size("s").alias("item_shingles"), F.explode("s").alias("shingle")))
    doc_words = again.select("doc_id", "text_hash", _tokens(F.col("_text")).alias("words"))
    own = [_shingles(F.col("words"), w, False) for w in widths]
    doc_keys = doc_words.select("doc_id", "text_hash", F.explode(
        F.concat(*own) if own else F.array().cast("array<string>")).alias("shingle"))
    shared = doc_keys.join(small(item_keys, item_keys.count()), "shingle").groupBy(
        "doc_id", "text_hash", "row", "item", "item_shingles").agg(F.count(F.lit(1)).alias("shared"))
    full = shared.filter(F.col("shared") * 100 >= F.col("item_shingles") * percent)
    found = full.join(
        candidates.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), F.col("row").alias("_r")),
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t")) & (F.col("row") == F.col("_r")),
        "left_semi")
    return found.groupBy("doc_id", "text_hash", F.col("item").alias("item_id")).agg(
        F.max_by(F.struct("shared", "item_shingles"), F.col("shared") / F.col("item_shingles")).alias("b")
    ).select("doc_id", "text_hash", "item_id", "b.shared", "b.item_shingles")


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that contain an item; all other rows and columns as they are."""
    found_id, found_text = fresh(docs, "found_id"), fresh(docs, "found_text")
    found = cut_lineage(find(docs, items, doc_id, text_col, item_id, item_text, percent).select(
        F.col("doc_id").alias(found_id), F.col("text_hash").alias(found_text)).distinct())
    return docs.join(small(found, found.count()), F.col(doc_id).eqNullSafe(F.col(found_id))
                     & (F.xxhash64(text_col) == F.col(found_text)), "left_anti")


def oracle_sql() -> str:
    """The query over ``documents`` and ``benchmark`` in DuckDB's SQL, by plain joins of shingles."""
    tokens = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, doc_id, w
  FROM (SELECT DISTINCT doc_id, text FROM documents), LATERAL (SELECT {tokens} AS w)),
items AS (
  SELECT row_number() OVER () AS item, item_id, w, least({WIDTH}, len(w)) AS width
  FROM (SELECT item_id, {tokens} AS w FROM benchmark) WHERE len(w) > 0),
item_shingles AS (
  SELECT DISTINCT item, item_id, width, array_to_string(w[i:i + width - 1], ' ') AS s
  FROM items, LATERAL (SELECT unnest(range(1, len(w) - width + 2)) AS i)),
doc_shingles AS (
  SELECT DISTINCT doc, doc_id, width, array_to_string(w[i:i + width - 1], ' ') AS s
  FROM docs, (SELECT DISTINCT width FROM items), LATERAL (SELECT unnest(range(1, len(w) - width + 2)) AS i)),
sizes AS (SELECT item, count(*) AS n FROM item_shingles GROUP BY item),
shared AS (
  SELECT doc, doc_id, item, item_id, count(*) AS shared
  FROM doc_shingles JOIN item_shingles USING (width, s) GROUP BY ALL)
SELECT doc_id, item_id, max_by(shared, shared / n) AS shared, max_by(n, shared / n) AS item_shingles
FROM shared JOIN sizes USING (item) WHERE shared * 100 >= n * {PERCENT} GROUP BY doc, doc_id, item_id"""
