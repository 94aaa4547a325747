"""Order MinHash fingerprints, in DataFrame functions alone.

A text's words give k-mers; equal k-mers of a text are numbered, so that each pair of k-mer and number occurs once. Each slot
selects its two smallest pairs, puts them into text order again and hashes the tuple. Two texts agree in a slot if they have the
selected k-mers in the same order, which falls with their edit distance rather than with their sets.

Every slot ranks all pairs of a text by an order of its own, as SuperMinHash does it: a pair visits the 64 slots in a random sequence
of its own, one a round, and a slot ranks by the round of the visit and then by a hash of pair and round. A text needs only the rounds
until every slot has been visited twice, about 768 visits, so long texts stop after the first; of their visits only those of small
hashes are sorted at all, and the rest only if these leave a slot unfilled.

Arrays of 64-bit numbers hold the upper 40 bits of a hash and 24 bits of the position, so that plain sorting groups and orders them. A
text of more than 16,777,216 words has no room for its positions and stops the query with an error that says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of a k-mer, slots of a fingerprint, k-mers of a slot's tuple, and bits of a number that hold the position.
KMER, SLOTS, TUPLE, PLACE = 2, 64, 2, 24
#: Rows of a range of ids whose neighbours are found together, and most ranges.
RANGE_ROWS, MOST_RANGES = 500, 1 << 16
_LOW = (1 << PLACE) - 1
#: Visits of slots after which nearly every text has two in each slot, and bits of a visit's hash.
VISITS, RANK = 768, 28


def _let(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that is computed once for each row, even where functions of arrays refer to it for each element."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _above(x: Column) -> Column:
    return F.shiftright(x, PLACE)


def _slot(x: Column) -> Column:
    return F.shiftrightunsigned(x, 58)


def _packed(h: Column, place: Column) -> Column:
    return h.bitwiseAND(F.lit(~_LOW)).bitwiseOR(place.cast("long").bitwiseAND(F.lit(_LOW)))


def _numbered(kmers: Column, x: Column, i: Column) -> Column:
    """How many equal k-mers stand before place ``i`` of the sorted array, by steps that halve."""
    steps = F.array(*(F.lit(1 << b) for b in range(PLACE - 1, -1, -1)))
    same = lambda n: F.coalesce(_above(F.get(kmers, i - n)) == _above(x), F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda n, d: F.when((i >= n + d) & same(n + d), n + d).otherwise(n))


def _visit(x: Column, r: Column) -> Column:
    """A pair's visit in round ``r``: slot, round, hash and position; over all rounds a pair visits each slot once."""
    bits = lambda at, n: F.shiftright(x, PLACE + at).bitwiseAND(F.lit(n))
    r = r.cast("long")
    turned = (r * bits(0, 62).bitwiseOR(F.lit(1)) + bits(6, 63)).bitwiseAND(F.lit(63))
    turned = turned.bitwiseXOR(F.shiftright(turned, 3))
    slot = (turned * bits(12, 62).bitwiseOR(F.lit(1)) + bits(18, 63)).bitwiseAND(F.lit(63))
    rank = F.xxhash64(_above(x), r).bitwiseAND(F.lit((1 << RANK) - 1))
    high = F.shiftleft(slot, 58).bitwiseOR(F.shiftleft(r, PLACE + RANK))
    return high.bitwiseOR(F.shiftleft(rank, PLACE)).bitwiseOR(x.bitwiseAND(F.lit(_LOW)))


def _least(visits: Column) -> Column:
    """The smallest two of each slot of a sorted array."""
    return F.filter(visits, lambda x, i: (i < TUPLE) | (_slot(F.get(visits, i - TUPLE)) != _slot(x)))


def _least_of_own_orders(df: DataFrame, kept: list[str]) -> DataFrame:
    """Adds ``_least`` from ``_pairs``: each slot's two smallest of all pairs, by as many visits as the text needs.

    The first try of a long text takes the visits of one round below a hash that about VISITS of them are below: a slot with two of
    them has its two smallest. The next tries take all visits of as many rounds as may be needed.
    """
    pairs, n, none = F.col("_pairs"), F.size("_pairs"), F.array().cast("array<long>")
    first = F.greatest(F.ceil(F.lit(VISITS) / F.greatest(n, F.lit(1))), F.lit(1)).cast("int")
    low = F.floor(F.lit(float(1 << RANK)) * VISITS / F.greatest(n, F.lit(1))).cast("long")
    df = df.select(*kept, "_pairs", none.alias("_least"), low.alias("_low"))
    rank = lambda v: F.shiftright(v, PLACE).bitwiseAND(F.lit((1 << RANK) - 1))
    every = lambda rounds: F.flatten(F.transform(F.sequence(F.lit(0), F.least(rounds, F.lit(SLOTS)) - 1), lambda r: F.transform(pairs, lambda x: _visit(x, r))))
    for rounds in (None, first, 2 * first, F.lit(SLOTS)):
        whole = F.size("_least") == SLOTS * F.least(n, F.lit(TUPLE))  # by an earlier try
        if rounds is None:
            tried = F.when(n >= 2 * VISITS, F.filter(F.transform(pairs, lambda x: _visit(x, F.lit(0))), lambda v: rank(v) < F.col("_low")))
        else:
            tried = F.when(~whole, every(rounds))
        df = _let(df, "_visits", F.sort_array(F.coalesce(tried, none)))
        df = _let(df, "_found", F.when(whole, F.col("_least")).otherwise(_least(F.col("_visits"))))
        df = df.select(*kept, "_pairs", F.col("_found").alias("_least"), "_low")
    return df.select(*kept, "_least")


def with_signature(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds a signature column: for each filled slot, in the order of signed hashes, the slot's number times 65536 and 16 bits of its tuple's hash.

    Null and blank texts fill no slot; a text of more words than positions have room for raises an error. Words end at ASCII white space; the last k-mers of a text are shorter. A k-mer's first
    occurrence is its own hash, later ones hash it with their number.
    """
    kept = df.columns
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), "\t\n\x0b\x0c\r", " " * 5)
    df = _let(df.select(*kept, plain.alias("_plain")), "_words", F.array_remove(F.split("_plain", " "), "")).drop("_plain")
    room = F.raise_error(F.concat(F.lit("a text has "), F.size("_words").cast("string"), F.lit(f" words; positions have room for {_LOW + 1}")))
    df = df.select(*kept, F.when(F.size("_words") <= _LOW + 1, F.col("_words")).otherwise(room).alias("_words"))
    words = F.col("_words")
    kmer = lambda x, i: _packed(F.xxhash64(x, *(F.get(words, i + k) for k in range(1, KMER))), i)
    df = _let(df, "_hashes", F.transform(words, kmer))
    df = df.select(*kept, F.sort_array("_hashes").alias("_kmers"))
    kmers = F.col("_kmers")
    again = lambda x, i: _packed(F.xxhash64(_above(x), _numbered(kmers, x, i)), x)
    df = _let(df, "_pairs", F.transform(kmers, lambda x, i: F.when(_above(F.get(kmers, i - 1)) == _above(x), again(x, i)).otherwise(x)))
    df = _least_of_own_orders(df, kept)
    least = F.col("_least")

    def tuple_of(x: Column, i: Column) -> Column:
        """The slot's two k-mers in text order, at the first of them; null at the second."""
        other = F.get(least, i + 1)
        place = lambda v: v.bitwiseAND(F.lit(_LOW))
        both = F.when(place(other) < place(x), F.xxhash64(_above(other), _above(x))).otherwise(F.xxhash64(_above(x), _above(other)))
        code = F.when(_slot(other) == _slot(x), both).otherwise(F.xxhash64(_above(x)))
        made = F.shiftleft(_slot(x), 16).bitwiseOR(code.bitwiseAND(F.lit(0xFFFF)))
        return F.when((i > 0) & (_slot(F.get(least, i - 1)) == _slot(x)), F.lit(None)).otherwise(made).cast("int")

    return _let(df, name, F.array_compact(F.transform(least, tuple_of))).select(*kept, name)


def spelled(signature: str) -> Column:
    """A signature as text: for each filled slot two hex digits of its number and four of its hash."""
    return F.array_join(F.transform(F.col(signature), lambda x: F.lower(F.lpad(F.hex(x), 6, "0"))), "")


def likeness(a: str, b: str) -> Column:
    """Share of equal slots among those that either signature fills; 1 for two that fill none."""
    slots = lambda c: F.transform(F.col(c), lambda x: F.shiftright(x, 16))
    filled = F.size(F.array_union(slots(a), slots(b)))
    return F.when(F.col(a) == F.col(b), F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(filled, F.lit(1)))


def ranges(docs: DataFrame) -> list[int]:
    """Largest id of every range, the largest of all last; ids themselves, a bounded number of them."""
    ids = docs.select(_id().alias("id"))
    rows, top = ids.agg(F.count(F.lit(1)), F.max("id")).first()
    parts = min(max(rows // RANGE_ROWS, 1), MOST_RANGES)
    if parts == 1:
        return [top or 0]
    found = ids.agg(F.percentile_approx("id", [i / parts for i in range(1, parts + 1)], 10 * parts)).first()[0]
    return sorted({*found, top})


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long"))


def with_next(docs: DataFrame, carried: list[str], tops: list[int]) -> DataFrame:
    """Adds ``next_`` columns of the document with the next smaller doc_id; the smallest is followed by the largest.

    Ids are cut into ranges at known ids (``ranges`` of the same documents), and the largest document of a range also visits the range above as its last row, so that
    each row finds its neighbour in its own range after one shuffle. Null ids come last, rows of equal id in the order of texts.
    """
    docs = docs.withColumn("_id", _id())
    size = max(int(len(tops) ** 0.5), 1)
    every = F.array(*(F.lit(x).cast("long") for x in tops[size - 1 :: size])) if len(tops) >= size else F.array().cast("array<long>")
    below = lambda xs: F.size(F.filter(xs, lambda x: x < F.col("_id")))
    docs = _let(docs, "_block", below(every) * size)
    fine = F.slice(F.array(*(F.lit(x).cast("long") for x in tops)), F.col("_block") + 1, size)
    docs = _let(docs, "_part", F.col("_block") + below(fine))
    docs = _let(docs, "_top", F.get(F.array(*(F.lit(x).cast("long") for x in tops)), F.col("_part")))
    home = F.struct(F.col("_part").alias("range"), F.lit(0).alias("guest"))
    visit = F.struct(((F.col("_part") + 1) % len(tops)).alias("range"), F.lit(1).alias("guest"))
    stays = docs.select("*", F.explode(F.when(F.col("_top") == F.col("_id"), F.array(home, visit)).otherwise(F.array(home))).alias("_at"))
    order = Window.partitionBy("_at.range").orderBy(F.col("_at.guest"), F.col("_id").desc(), F.col("text").asc_nulls_first())
    with_lead = stays.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in carried))
    return with_lead.where("_at.guest = 0").drop("_id", "_block", "_part", "_top", "_at")


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next document's. A single
    document follows itself; null texts are empty; repeated rows follow one another; no documents give no row.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    tops = ranges(docs)  # from the ids alone, before texts are read
    docs = with_next(with_signature(docs, "text", "signature"), ["text", "signature"], tops)
    docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.expr("CAST(n_chars div 2 AS INT)")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    docs = _let(docs, "edited", edited).drop("text", "next_text")
    docs = with_signature(docs.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "edited_signature")
    return docs.select(
        "doc_id", "n_chars", "edited_sha256", spelled("signature").alias("fingerprint"), spelled("edited_signature").alias("edited_fingerprint"),
        likeness("signature", "edited_signature").alias("near_edited"), likeness("signature", "next_signature").alias("near_next"),
    )
