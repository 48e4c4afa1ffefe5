"""Document fingerprints by one-permutation MinHash.

The hash of every word shingle is used once: its low bits choose one of 128
bins, the rest is its value, and a bin keeps its least value. An empty bin
borrows from the filled bin that comes first in an order drawn for that empty
bin alone (optimal densification), so equal choices mean equal sets, not equal
gaps. Of every bin the lowest eight bits are stored; two unrelated bins agree
with a chance of 1/256, which the likeness is corrected for.

All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ackline.llm.common import keep, prepare, with_once
from ackline.llm.licenses import shingle_hashes, words
from ackline.plans.scan import Running, prefix_scan

BINS = 128
BITS = 8
SHINGLE = 5
VALUE_BITS = 56
# Levels of the scan for the next id: no task sorts more than 2**13 ids at once.
LEVELS = (13, 13, 13, 12)


def _hashes(parts: str) -> Column:
    """Shingle hashes; with too few words the whole sequence is the one shingle."""
    few = F.array(F.xxhash64(F.array_join(parts, " ")))
    none = F.array().cast("array<bigint>")
    return F.when(F.size(parts) >= SHINGLE, shingle_hashes(parts, SHINGLE)).when(F.size(parts) > 0, few).otherwise(none)


def _binned(hashes: str) -> Column:
    """``bin << 56 | value`` of every hash, sorted."""
    keyed = F.transform(
        hashes,
        lambda h: F.shiftleft(h.bitwiseAND(F.lit(BINS - 1)), VALUE_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - VALUE_BITS)),
    )
    return F.sort_array(keyed)


def _first_of_bins(binned: str) -> Column:
    """The least entry of every filled bin."""
    before = lambda i: F.get(F.col(binned), i - 1)
    new = lambda x, i: (i == 0) | (F.shiftright(x, VALUE_BITS) != F.shiftright(before(i), VALUE_BITS))
    return F.filter(binned, new)


def _densified(filled: str) -> Column:
    """The stored bits of all bins; no bins if none is filled."""
    low = (1 << BITS) - 1
    bin_of = lambda x: F.shiftright(x, VALUE_BITS).cast("int")
    empty = F.array_except(F.sequence(F.lit(0), F.lit(BINS - 1)), F.transform(filled, bin_of))

    def borrowed(b: Column) -> Column:
        order = F.transform(
            filled,
            lambda x: F.shiftleft(F.hash(b, bin_of(x)).cast("long").bitwiseAND(F.lit(0x7FFFFFFF)), BITS).bitwiseOR(x.bitwiseAND(F.lit(low))),
        )
        return F.shiftleft(b.cast("long"), VALUE_BITS).bitwiseOR(F.array_min(order).bitwiseAND(F.lit(low)))

    whole = F.sort_array(F.concat(filled, F.transform(empty, borrowed)))
    codes = F.transform(whole, lambda x: x.bitwiseAND(F.lit(low)).cast("short"))
    return F.when(F.size(filled) > 0, codes).otherwise(F.array().cast("array<smallint>"))


def with_codes(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the fingerprint of column ``text`` as an array of its bins' bits."""
    columns = df.columns
    df = with_once(df, "_parts", words(F.col(text)))
    df = with_once(df, "_hashes", _hashes("_parts")).drop("_parts")
    df = with_once(df, "_binned", _binned("_hashes")).drop("_hashes")
    df = with_once(df, "_filled", _first_of_bins("_binned")).drop("_binned")
    return with_once(df, name, _densified("_filled")).select(*columns, name)


def packed(codes: str) -> Column:
    """The fingerprint as text: two hexadecimal digits a bin, empty for no words."""
    return F.lower(F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c.cast("long")), 2, "0")), ""))


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity: shares of agreeing bins, less chance agreement."""
    chance = 1.0 / (1 << BITS)
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda agree: agree)) / BINS
    corrected = F.greatest(F.lit(0.0), (same - chance) / (1 - chance))
    none = F.size(a) + F.size(b) == 0
    one_none = (F.size(a) == 0) | (F.size(b) == 0)
    return F.when(none, 1.0).when(one_none | F.col(a).isNull() | F.col(b).isNull(), 0.0).otherwise(corrected)


def next_ids(ids: DataFrame) -> DataFrame:
    """``(doc_id, next_id)`` of every id: the greatest lesser id; the least has the greatest."""
    ids = keep(ids.filter(F.col("doc_id").isNotNull()).distinct(), "document-ids")
    scanned = prefix_scan(ids, "doc_id", [Running("max", F.col("doc_id"), "next_id", exclusive=True)], block_bits=LEVELS)
    last = ids.agg(F.max("doc_id")).first()[0]
    return scanned.select("doc_id", F.coalesce("next_id", F.lit(last).cast("long")).alias("next_id"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. The edited text has its last ``n_chars // 2``
    characters replaced by the first as many of the next document by falling id
    (after the last the first). A null text is an empty one. Two texts without
    words are alike (1), one without is unlike any other (0). If rows repeat an
    id, each has a result and the first text of an id in byte order is what
    precedes it in the order. Rows with a null id have no next document: their
    edited text is what is left of theirs.
    """
    prepare(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = keep(next_ids(texts.select("doc_id")), "next-ids")
    half = F.floor(F.length("text") / 2).cast("int")
    sizes = keep(texts.groupBy("doc_id").agg(F.max(half).alias("head_length"), F.count("*").alias("uses")), "text-sizes")
    wanting = order.join(sizes, "doc_id").select(
        F.col("next_id").alias("doc_id"), F.col("doc_id").alias("wanted_by"), "head_length"
    )
    known = texts.filter(F.col("doc_id").isNotNull())
    digest = F.xxhash64("text")
    prints = keep(with_codes(known, "text", "codes").select("doc_id", digest.alias("of"), "codes"), "fingerprints")
    by_id = prints.groupBy("doc_id").agg(F.collect_set(F.struct("of", "codes")).alias("prints"))
    own = F.filter("prints", lambda p: p["of"] == digest)[0]["codes"].alias("codes")
    # One exchange of the texts by id serves both: their own row, and what the
    # document before them takes of them. Every id is wanted by one.
    placed = known.join(wanting.join(by_id, "doc_id"), "doc_id")
    heads = placed.select(
        F.col("wanted_by").alias("doc_id"),
        F.expr("substring(text, 1, head_length)").alias("head"),
        own.alias("next_codes"),
    )
    if not sizes.filter("uses > 1 and doc_id is not null").isEmpty():
        first = F.min(F.struct("head", "next_codes")).alias("first")
        heads = heads.groupBy("doc_id").agg(first).select("doc_id", "first.head", "first.next_codes")
    joined = placed.select("doc_id", "text", own).join(heads, "doc_id")
    apart = with_codes(texts.filter(F.col("doc_id").isNull()), "text", "codes")
    nothing = {"head": F.lit(None).cast("string"), "next_codes": F.lit(None).cast("array<smallint>")}
    joined = joined.unionByName(apart.withColumns(nothing))
    edited = joined.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited",
        F.concat(
            F.expr("substring(text, 1, cast(n_chars - n_chars div 2 as int))"),
            F.coalesce(F.expr("substring(head, 1, cast(n_chars div 2 as int))"), F.lit("")),
        ),
    )
    edited = edited.select("doc_id", "n_chars", "codes", "next_codes", "edited")
    both = with_codes(edited, "edited", "edited_codes")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        packed("codes").alias("fingerprint"),
        packed("edited_codes").alias("edited_fingerprint"),
        likeness("codes", "edited_codes").alias("near_edited"),
        likeness("codes", "next_codes").alias("near_next"),
    )
