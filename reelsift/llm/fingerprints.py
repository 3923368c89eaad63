"""SimHash fingerprints, and all fingerprints within a Hamming radius by permuted block tables.

A text's terms are its pairs of neighbouring words. Every bit of a term's hash votes for or against that bit of the
fingerprint with the term's weight, its characters; a term that stands twice votes twice. The bits whose votes for
outweigh those against are set. Only DataFrame functions: one pass of sums over the terms, no text leaves its task for it.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift.operators.ranking import global_row_number
from reelsift.session import durable

BITS = 64
RADIUS = 3
#: Blocks that a fingerprint is cut into. Two fingerprints within the radius agree in all but ``RADIUS`` of them.
BLOCKS = 6
_WORDS = r"[\x09-\x0D\x20]+"
_LANES = 0x0000000100000001


def _votes(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``fingerprint`` of the texts of each row; texts without words have fingerprint 0."""
    words = F.split(F.trim(F.regexp_replace(text, _WORDS, " ")), " ")
    terms = rows.withColumn("_words", words).select(
        *keys, F.inline(F.arrays_zip(F.col("_words").alias("a"), F.slice("_words", 2, F.size("_words")).alias("b")))
    ).toDF(*keys, "a", "b")
    # The last word pairs with nothing; it votes alone only where it is the only one.
    weight = F.length("a") + F.coalesce(F.length("b"), F.lit(0))
    terms = terms.select(*keys, F.xxhash64("a", "b").alias("h"), weight.cast("long").alias("w"))
    # One sum counts two bits, each in its own half of the number: halves overflow beyond 2**32 characters.
    sums = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(_LANES)) * F.col("w")).alias(f"s{i}") for i in range(BITS // 2)]
    summed = terms.groupBy(*keys).agg(F.sum("w").alias("total"), *sums)
    low = [F.col(f"s{i}").bitwiseAND(F.lit(0xFFFFFFFF)) for i in range(BITS // 2)]
    high = [F.shiftrightunsigned(f"s{i}", BITS // 2) for i in range(BITS // 2)]
    bits = [F.when(2 * v > F.col("total"), F.lit(_signed(1 << i))).otherwise(F.lit(0)) for i, v in enumerate([*low, *high])]
    return summed.select(*keys, reduce(lambda x, y: x.bitwiseOR(y), bits).cast("long").alias("fingerprint"))


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def likeness(a: Column, b: Column) -> Column:
    """Share of bits in which two fingerprints agree."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / BITS


def told(fingerprint: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), BITS // 4, "0"))


def block_tables(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """Masks of the bits that each table is keyed by: every choice of ``blocks - radius`` blocks."""
    edges = [round(k * BITS / blocks) for k in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [sum(chosen) for chosen in combinations(masks, blocks - radius)]


def within_radius(fingerprints: DataFrame, wanted: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``wanted, fingerprint, n``: for each distinct ``fingerprint`` of ``wanted`` those of ``fingerprints`` (``fingerprint, n``) within the radius.

    Both tables must hold distinct fingerprints. Every fingerprint stands in each table under the bits that the table keeps. Two within the
    radius differ in ``radius`` blocks at most, so some table has them under the same key; they are taken from the first that has.
    """
    masks = [F.lit(_signed(m)) for m in block_tables(radius, blocks)]
    tables = F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(m) for m in masks]))
    left = fingerprints.select("fingerprint", "n", tables.alias("table", "key"))
    right = wanted.select(F.col("fingerprint").alias("wanted"), tables.alias("table", "key"))
    pairs = left.join(right, ["table", "key"])
    apart = F.col("fingerprint").bitwiseXOR(F.col("wanted"))
    first = F.coalesce(*[F.when(apart.bitwiseAND(m) == 0, F.lit(t)) for t, m in enumerate(masks)])
    return pairs.where((F.bit_count(apart) <= radius) & (F.col("table") == first)).select("wanted", "fingerprint", "n")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """``fingerprint`` (long) next to all columns of ``docs``; null texts are empty."""
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    rows = durable(rows)
    votes = _votes(rows.select("_row", F.coalesce("text", F.lit("")).alias("_text")), ["_row"], "_text")
    return rows.join(votes, "_row").drop("_row")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and how like they are, and the next document's.

    The edited text has its last half replaced by as much of the beginning of the next document, by ascending ``doc_id``, the first
    following the last. Rows without id come first; rows with the same id follow by a hash of the text; rows that agree in both stand in
    one place and get the same result. Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint`` (long), ``near_edited, near_next``.

    The texts are shuffled once by row; another shuffle takes to each row the part of the next text that it needs.
    """
    # A row is known by a hash of its id and text; where that should ever meet, the ids tell rows apart.
    row_key = F.xxhash64("doc_id", F.col("doc_id").isNull(), "text")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("k", row_key)
    entries = keyed.groupBy("doc_id", "k", F.length("text").cast("long").alias("n")).agg(F.count("*").alias("copies"))
    places = durable(global_row_number(entries, ["doc_id", "k"], "place"))
    last = places.count()
    follow = F.when(F.col("place") == last, F.lit(1)).otherwise(F.col("place") + 1)
    before = places.select(follow.alias("place"), F.col("k").alias("k_before"), F.col("place").alias("place_before"), F.floor(F.col("n") / 2).cast("int").alias("needed"))
    plan = durable(places.join(before, "place"))
    texts = keyed.dropDuplicates(["doc_id", "k"]) if places.where("copies > 1").limit(1).count() else keyed
    # Not an equality of two columns: as a second key it would be part of the partitioning, and the texts shuffled again for the next join.
    same_id = F.coalesce("t.doc_id", F.lit(0)).bitwiseXOR(F.coalesce("p.doc_id", F.lit(0))) == 0
    mine = texts.alias("t").join(plan.alias("p"), (F.col("t.k") == F.col("p.k")) & same_id)
    own = mine.select(F.col("t.k").alias("k"), "t.text", "p.place", "p.doc_id", "p.copies", F.length("t.text").alias("n"))
    heads = mine.select(F.col("p.k_before").alias("k"), F.col("p.place_before").alias("_place"), F.expr("substring(t.text, 1, p.needed)").alias("head"))
    both = own.join(heads, "k").where(F.col("place").bitwiseXOR(F.col("_place")) == 0)
    edited = F.concat(F.expr("substring(text, 1, n - int(floor(n / 2)))"), F.col("head"))
    both = both.select("k", "place", "doc_id", "copies", F.col("n").cast("long").alias("n_chars"), "text", edited.alias("edited"))
    both = both.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    keys = ["k", "place", "doc_id", "copies", "n_chars", "edited_sha256", "is_edited"]
    split = both.select(*keys[:-1], F.inline(F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("_text")), F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("_text")))))
    votes = _votes(split, keys, "_text")
    kinds = [F.max(F.when(F.col("is_edited") == e, F.col("fingerprint"))).alias(c) for e, c in ((False, "fingerprint"), (True, "edited_fingerprint"))]
    made = durable(votes.groupBy(*keys[:-1]).agg(*kinds))
    previous = F.when(F.col("place") == 1, F.lit(last)).otherwise(F.col("place") - 1)
    following = made.select(previous.alias("place"), F.col("fingerprint").alias("_next"))
    rows = made.join(following, "place").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"),
    )


def with_neighbours(rows: DataFrame, every: int = 50, radius: int = RADIUS) -> DataFrame:
    """``rows`` (``doc_id, fingerprint``) with ``n_within``: for ids divisible by ``every`` the other rows within the radius, null for all else."""
    rows = durable(rows)
    asked = F.col("doc_id") % every == 0
    counts = rows.groupBy("fingerprint").agg(F.count("*").alias("n"), F.bool_or(F.coalesce(asked, F.lit(False))).alias("_asked"))
    counts = durable(counts)
    found = within_radius(counts.select("fingerprint", "n"), counts.where("_asked").select("fingerprint"), radius)
    found = found.groupBy("wanted").agg((F.sum("n") - 1).alias("_within")).withColumnRenamed("wanted", "fingerprint")
    return rows.join(found, "fingerprint", "left").withColumn("n_within", F.when(asked, F.col("_within"))).drop("_within")
