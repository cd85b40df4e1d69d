"""Repair of conversations: the cheapest edits that make the roles ``(s?(ua)+)?``, decided by whole numbers alone.

A way through a conversation is one big number. Its high digits are the cost; below them stand the letters of its edits
at fixed width, first letter first, three bits each (D 1, I 2, K 3, R 4, in ASCII order), with zeros behind the end. The
least number is then the least cost, and of equal costs the ASCII-least letters; the search is an ordinary shortest way
through a graph of (row, state), from the last row to the first.

A long conversation is spread over tasks: rows are range-partitioned by conversation and turn, each task reduces its
piece to the best way from each state to each state (16 numbers), and those are put together as in a matrix product. Two
ways over the same rows with one cost can't be such that one's letters begin the other's (what is longer has more
inserts, so costs more), so the better of two pieces stays better, whatever follows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comanda.session import cut_lineage

BLANK = r"\x20\x09-\x0D"
LETTERS = "DIKR"  # digits 1 to 4
BITS = 3
# Costs of the edits; a truncated row that is not deleted adds TRUNCATED.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
INITIALS = "sua"
# States: nothing yet, after the system's row, after a user's, after an assistant's. The first and last may end it.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES = 4
MOST = 3  # letters for a row: two inserts and its own
BLOCK = 64  # rows whose numbers are made at once; longer pieces are put together from these

Ways = tuple[int, tuple[tuple[int | None, ...], ...]]  # letters of width, best number from each state to each state


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults planted by crc32 of ``conv_id:turn``; null texts and roles are one space.

    Of 20 remainders 0 drops a row, 1 empties its text, 2 takes its ``.!?`` away, 3 doubles it, 4 makes it the user's.
    """
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))
    rows = conversations.select(
        "conv_id", "turn", or_space("role").alias("role"), or_space("text").alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault")).filter("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(times).alias("time"))
    return rows.drop("time")


def _inserts(state: int) -> list[int]:
    """The states that 0, 1, 2.. inserts lead to, none twice."""
    out = [state]
    while (after := STEP.get((out[-1], "u"), STEP.get((out[-1], "a")))) not in out:
        out.append(after)
    return out


def _edits(initial: str | None, fault: int, state: int) -> list[tuple[int, int, int, int]]:
    """(cost, letters as digits, number of letters, next state) of what can be done up to and with a row."""
    out = []
    for inserts, at in enumerate(_inserts(state)):
        own = [("D", DELETE, at)]
        if fault < 2:
            more = TRUNCATED if fault == 1 else 0
            own += [("K", KEEP + more, STEP[at, initial])] if (at, initial) in STEP else []
            own += [("R", REROLE + more, STEP[at, new]) for new in "ua" if (at, new) in STEP]
        for letter, cost, after in own:
            digits = 0
            for x in "I" * inserts + letter:
                digits = digits << BITS | LETTERS.index(x) + 1
            out.append((cost + INSERT * inserts, digits, inserts + 1, after))
    return out


#: By class of a row (4 x initial + fault; faults: 0 none, 1 truncated, 2 blank, 3 duplicate) and state.
EDITS = [[_edits([*INITIALS, None][c // 4], c % 4, q) for q in range(STATES)] for c in range(16)]


@lru_cache(maxsize=1 << 14)
def block_ways(classes: bytes) -> Ways:
    """The best way over a block of rows from each state to each state."""
    width = MOST * len(classes)
    bits = BITS * width
    mask = (1 << bits) - 1
    best = [[0 if q == t else None for t in range(STATES)] for q in range(STATES)]
    for row in reversed(classes):
        best = [[min((
            (((rest := best[after][t]) >> bits) + cost << bits) | digits << bits - BITS * n | (rest & mask) >> BITS * n
            for cost, digits, n, after in EDITS[row][q] if best[after][t] is not None), default=None)
            for t in range(STATES)] for q in range(STATES)]
    return width, tuple(map(tuple, best))


def _joined(a: int, wide_a: int, b: int, wide_b: int) -> int:
    """One number for a way and the one that follows it: costs added, the letters of the second right behind the first's."""
    bits_a, bits_b = BITS * wide_a, BITS * wide_b
    low = a & (1 << bits_a) - 1
    unused = ((low & -low).bit_length() - 1) // BITS if low else wide_a
    letters = low << bits_b | (b & (1 << bits_b) - 1) << BITS * unused
    return ((a >> bits_a) + (b >> bits_b) << bits_a + bits_b) | letters


def joined(first: Ways, second: Ways) -> Ways:
    (wide_a, a), (wide_b, b) = first, second
    return wide_a + wide_b, tuple(tuple(min((
        _joined(a[q][m], wide_a, b[m][t], wide_b) for m in range(STATES) if a[q][m] is not None and b[m][t] is not None),
        default=None) for t in range(STATES)) for q in range(STATES))


def piece_ways(classes: bytes) -> Ways:
    """The best ways over any number of rows, put together by halves."""
    ways = [block_ways(classes[i:i + BLOCK]) for i in range(0, len(classes), BLOCK)] or [block_ways(b"")]
    return together(ways)


def together(ways: list[Ways]) -> Ways:
    while len(ways) > 1:
        ways = [joined(*ways[i:i + 2]) if i + 1 < len(ways) else ways[i] for i in range(0, len(ways), 2)]
    return ways[0]


def cheapest(ways: Ways) -> tuple[int, str]:
    """(cost, audit) of the best way to an end: with the inserts that an open turn needs."""
    width, best = ways
    ends = {0: 0, 3: 0, 2: INSERT << 2 * BITS | 2 << BITS, 1: 2 * INSERT << 2 * BITS | 2 << BITS | 2}
    number = min(_joined(best[0][t], width, end, 2) for t, end in ends.items() if best[0][t] is not None)
    bits = BITS * (width + 2)
    digits = format(number & (1 << bits) - 1, "o").zfill(width + 2).rstrip("0")  # three bits are an octal digit
    return number >> bits, digits.translate(str.maketrans("1234", LETTERS))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, bool, pa.RecordBatch]]:
    """Runs of rows with one value in the first column: (value, whether a new run begins, rows). Null is a value."""
    at, begun = None, False
    for batch in batches:
        codes = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        cuts = [0, *((codes[1:] != codes[:-1]).nonzero()[0] + 1).tolist(), len(codes)] if len(codes) else []
        for a, b in zip(cuts, cuts[1:]):
            value = batch.column(0)[a].as_py()
            yield value, not begun or value != at, batch.slice(a, b - a)
            at, begun = value, True


def _keyed(rows: DataFrame) -> DataFrame:
    """The rows with the digest of their text, blank and truncated."""
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.unhex(F.sha2(text, 256)).alias("body"),
        text.alias("text"), (~text.rlike(f"[^{BLANK}]")).alias("blank"), (~text.rlike(rf"[.!?][{BLANK}]*\z")).alias("open"))


KEY = ["conv_id", "turn", "role", "body"]


def _in_order(keyed: DataFrame) -> DataFrame:
    """(conv_id, turn, role, body, class, place): rows by conversation and turn, dealt evenly, each with its class.

    Equal rows are counted before they are dealt, and a row's copies may be dealt to several tasks.
    """
    counted = keyed.groupBy(*KEY).agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("open").alias("open"))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = counted.groupBy("conv_id", "role", "body").agg(F.min(when).alias("first")).select(
        F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("body").alias("_b"), "first")
    seen = counted.join(
        first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("body") == F.col("_b")))
    rows = seen.withColumn("later", ~when.eqNullSafe(F.col("first"))).withColumn("copy", F.explode(F.sequence(F.lit(1), "n")))
    fault = F.when(F.col("blank"), 2).when(F.col("later") | (F.col("copy") > 1), 3).when(F.col("open"), 1).otherwise(0)
    initial = F.lit(len(INITIALS))
    for i, letter in enumerate(INITIALS):
        initial = F.when(F.substring("role", 1, 1) == letter, i).otherwise(initial)
    rows = rows.select(*KEY, "copy", (initial * 4 + fault).alias("class"))
    dealt = rows.repartitionByRange(*KEY, "copy").sortWithinPartitions(*KEY, "copy")
    return cut_lineage(dealt.select(*KEY, "class", F.monotonically_increasing_id().alias("place")))


def _pieces(ordered: DataFrame) -> DataFrame:
    """A conversation's rows in one task: where they begin, how many, their faults, and the best ways over them."""
    schema = T.StructType([
        ordered.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in (
            "place", "size", "blank", "duplicate", "truncated", "illegal", "initial", "final")),
        T.StructField("ways", T.ArrayType(T.BinaryType()))])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, place, classes = None, 0, bytearray()

        def piece() -> pa.RecordBatch:
            faults, initials = [c % 4 for c in classes], [c // 4 for c in classes]
            ways = piece_ways(bytes(classes))[1]
            numbers = [
                place, len(classes), faults.count(2), faults.count(3), faults.count(1), sum(map(_illegal, initials, initials[1:])),
                initials[0], initials[-1]]
            flat = [None if w is None else w.to_bytes(w.bit_length() // 8 + 1, "big") for row in ways for w in row]
            return pa.RecordBatch.from_arrays(
                [pa.array([key], key_type), *(pa.array([v], pa.int64()) for v in numbers), pa.array([flat], pa.list_(pa.binary()))],
                [f.name for f in schema])

        for value, new, part in _slices(batches):
            key_type = part.schema.field(0).type
            if new:
                if classes:
                    yield piece()
                key, place, classes = value, part.column(1)[0].as_py(), bytearray()
            classes += bytes(part.column(2).to_pylist())
        if classes:
            yield piece()

    return ordered.select("conv_id", "place", "class").mapInArrow(reduce, schema)


def _illegal(before: int, after: int) -> bool:
    return (before, after) not in ((0, 1), (1, 2), (2, 1))


def _decided(pieces: DataFrame) -> DataFrame:
    """A row for each conversation: its counts, cost and audit, and the places and sizes of its pieces."""
    names = ["blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType([
        pieces.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in names), T.StructField("audit", T.StringType()),
        *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("places", "sizes"))])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def row() -> pa.RecordBatch:
            ways = together([(MOST * p["size"], tuple(
                tuple(None if w is None else int.from_bytes(w, "big") for w in p["ways"][q * STATES:(q + 1) * STATES])
                for q in range(STATES))) for p in held])
            cost, audit = cheapest(ways)
            counts = [sum(p[c] for p in held) for c in names[:4]]
            counts[3] += sum(_illegal(a["final"], b["initial"]) for a, b in zip(held, held[1:]))
            return pa.RecordBatch.from_arrays([
                pa.array([key], key_type), *(pa.array([v], pa.int64()) for v in [*counts, cost]), pa.array([audit]),
                *(pa.array([[p[c] for p in held]], pa.list_(pa.int64())) for c in ("place", "size"))], [f.name for f in schema])

        for value, new, part in _slices(batches):
            key_type = part.schema.field(0).type
            if new:
                if held:
                    yield row()
                key, held = value, []
            held += part.to_pylist()
        if held:
            yield row()

    dealt = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return dealt.mapInArrow(decide, schema)


def _lines(decided: DataFrame) -> DataFrame:
    """(conv_id, line, edit, place of the row, new role) of what the audits leave; inserts have no place."""
    schema = T.StructType([
        decided.schema["conv_id"], T.StructField("line", T.LongType()), T.StructField("edit", T.StringType()),
        T.StructField("place", T.LongType()), T.StructField("new_role", T.StringType())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, audit, places, sizes in zip(batch.column(0), *(c.to_pylist() for c in batch.columns[1:])):
                rows = (place + i for place, size in zip(places, sizes) for i in range(size))
                system = (len(audit) - audit.count("D")) % 2  # turns come in pairs behind it
                line, out = 0, []
                for n, edit in enumerate(audit):
                    place = None if edit == "I" else next(rows)
                    if edit != "D":
                        out.append((line, edit, place, None if edit == "K" else ("user", "assistant")[(line - system) % 2]))
                        line += 1
                    if out and (len(out) == 10_000 or n == len(audit) - 1):
                        yield pa.RecordBatch.from_arrays([
                            pa.array([key.as_py()] * len(out), key.type),
                            *(pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int64(), pa.string())))],
                            [f.name for f in schema])
                        out = []

    return decided.select("conv_id", "audit", "places", "sizes").mapInArrow(write, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is wrong with each conversation and how to mend it, and the mended rows.

    ``rows`` has conv_id, turn, role and text; other columns don't matter. The first result has a row for each conv_id:
    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit). The second has the repaired rows: (conv_id, line
    from 0, edit, turn, role, text); inserted ones have no turn and an empty text.

    Rows go by turn, null first; those of one turn by role, then by the digest of their text. Null roles and texts are one
    space. A null conv_id is a conversation like others. Equal rows are duplicates of each other. Of an empty table both
    results are empty; a conversation of which nothing is left has a row in the first only.
    """
    keyed = _keyed(rows)
    ordered = _in_order(keyed)
    decided = cut_lineage(_decided(_pieces(ordered)))
    gaps = ordered.groupBy(F.col("conv_id").alias("_c")).agg(F.coalesce(
        F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    report = decided.join(gaps, F.col("conv_id").eqNullSafe(F.col("_c"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    placed = _lines(decided).join(
        ordered.select("turn", "role", "body", F.col("place").alias("_p")), F.col("place") == F.col("_p"), "left")
    texts = keyed.groupBy(*KEY).agg(F.first("text").alias("text")).select(
        *(F.col(c).alias(f"_{c}") for c in KEY), "text")
    found = placed.join(texts, F.col("conv_id").eqNullSafe(F.col("_conv_id")) & F.col("turn").eqNullSafe(F.col("_turn")) & (
        F.col("role") == F.col("_role")) & (F.col("body") == F.col("_body")), "left")
    repaired = found.select(
        "conv_id", "line", "edit", "turn", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return report, repaired


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of the repaired ``role:text`` lines. Rows stream by, none is held.

    A digest goes through its lines one after the other, so the lines of one conversation pass through one task.
    """
    schema = T.StructType([repaired.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        done = lambda: pa.RecordBatch.from_arrays(
            [pa.array([key], key_type), pa.array([state.hexdigest()])], [f.name for f in schema])
        for value, new, part in _slices(batches):
            key_type = part.schema.field(0).type
            if new:
                if state:
                    yield done()
                key, state = value, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update("\n".join(part.column(1).to_pylist()).encode("utf-8", "surrogatepass"))
        if state:
            yield done()

    lines = repaired.select("conv_id", "line", F.concat("role", F.lit(":"), "text").alias("said"))
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "line").select("conv_id", "said")
    return lines.mapInArrow(digest, schema)


def oracle_sql() -> str:
    """DuckDB SQL for the query: the same edits by a recursion over rows that keeps the best way to each state."""
    return r"""
WITH RECURSIVE crc(i, k, v) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc WHERE k < 8
), steps AS (SELECT list(v ORDER BY i) AS t FROM crc WHERE k = 8
), keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295,
        list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::bigint)),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS fault
    FROM conversations, steps
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM keyed, range(2) AS copy(c) WHERE fault <> 0 AND (c = 0 OR fault = 3)
), judged AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS initial,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), nth) AS n,
        CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
            WHEN nth > 1 THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM damaged)
), counts AS (
    SELECT conv_id, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM judged) GROUP BY conv_id
), step(q, initial, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), inserts(q, letters, q1) AS (
    SELECT q, '', q FROM range(4) AS s(q)
    UNION ALL SELECT i.q, letters || 'I', q2 FROM inserts i JOIN step s ON s.q = i.q1 AND s.initial IN ('u', 'a') AND len(letters) < 2
), way(conv_id, n, q, cost, audit) AS (
    SELECT conv_id, 0::bigint, 0, 0::bigint, '' FROM counts
    UNION ALL
    SELECT conv_id, n, q, split_part(w, ' ', 1)::bigint, split_part(w, ' ', 2) FROM (
        SELECT w.conv_id, r.n, e.q2 AS q, min(lpad((w.cost + 5 * len(i.letters) + e.cost
            + CASE WHEN e.letter <> 'D' AND r.fault = 'truncated' THEN 5 ELSE 0 END)::varchar, 15, '0') || ' ' || w.audit || i.letters || e.letter) AS w
        FROM way w JOIN judged r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.n = w.n + 1
        JOIN inserts i ON i.q = w.q
        JOIN (SELECT q, q AS q2, 'D' AS letter, 2 AS cost, NULL AS initial FROM range(4) AS s(q)
            UNION ALL SELECT q, q2, 'K', 0, initial FROM step
            UNION ALL SELECT q, q2, 'R', 1, NULL FROM step WHERE initial <> 's') e
        ON e.q = i.q1 AND (e.letter = 'D' OR r.fault NOT IN ('blank', 'duplicate')) AND (e.letter <> 'K' OR e.initial = r.initial)
        GROUP BY w.conv_id, r.n, e.q2)
), best AS (
    SELECT c.conv_id, min(lpad((cost + 5 * len(letters))::varchar, 15, '0') || ' ' || audit || letters) AS w
    FROM counts c JOIN way w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.n = c.n
    JOIN (VALUES (0, ''), (1, 'II'), (2, 'I'), (3, '')) AS ends(q, letters) ON ends.q = w.q GROUP BY c.conv_id
), decided AS (SELECT conv_id, split_part(w, ' ', 1)::bigint AS cost, split_part(w, ' ', 2) AS audit FROM best
), letters AS (
    SELECT conv_id, audit[i] AS edit, len(replace(audit[1:i], 'I', '')) AS n, len(replace(audit[1:i], 'D', '')) AS line,
        len(replace(audit, 'D', '')) % 2 AS system
    FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS i FROM decided)
), repaired AS (
    SELECT l.conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN r.role WHEN (line - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || CASE WHEN edit = 'I' THEN '' ELSE r.text END, chr(10) ORDER BY line)) AS digest
    FROM letters l LEFT JOIN judged r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.n = l.n AND edit <> 'I'
    WHERE edit <> 'D' GROUP BY l.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0)::bigint AS blank,
    coalesce(duplicate, 0)::bigint AS duplicate, coalesce(truncated, 0)::bigint AS truncated, coalesce(illegal, 0)::bigint AS illegal,
    coalesce(cost, 0)::bigint AS cost, coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN decided d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM o.conv_id"""
