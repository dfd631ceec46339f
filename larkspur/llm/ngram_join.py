"""N-gram Jaccard join by vertical partitioning of the n-gram order.

All n-grams have one global order, that of their hashes, and a set is cut where the order is cut. Two sets over the
threshold differ in few n-grams, so if the order is cut into more fragments than that, they agree wholly in
at least one. Sets of equal n-grams are one class. The steps:

1. Every class sends one signature per fragment. Classes that do not share as many as a link takes have none and are
   done; these are nearly all, and no more than a hash per some n-grams of theirs was shuffled.
2. For the others, n-grams are counted. One that no other class holds cannot overlap; the rarest of the others
   bring up the candidates, by the prefix rule.
3. A candidate pair is tested on its fragments: where the candidates meet, the smaller of the two sizes in each
   fragment, summed, must reach the overlap wanted; then partial overlaps are counted by fragment and summed per pair.
4. Pairs are tested first against the most central class of each n-gram. Only pairs that are not yet connected
   are tested after that, so a large group of near copies costs a star and not all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.components import components
from larkspur.llm.words import chain, find_words, hash_words, mix, shingle_hashes, signed, slices
from larkspur.session import cut_lineage

#: Fragments in which overlaps are counted, and finer ones whose sizes bound them before; powers of 2.
FRAGMENTS, SIZED = 16, 64
#: Buckets of the bit map of ids that spares most documents a shuffle; its size is fixed.
MAP_BITS = 20


class Threshold(NamedTuple):
    """Words of an n-gram, and the least Jaccard similarity in hundredths."""

    words: int = 5
    percent: int = 80

    def differing(self, size: int) -> int:
        """The most n-grams in which two sets of ``size`` at most can differ."""
        return 2 * size * (100 - self.percent) // (100 + self.percent)

    def size_class(self, size: int) -> int:
        """Sets whose sizes allow a link are in the same or in neighbouring classes."""
        if self.percent >= 100:
            return size
        return int(math.log(size) / (math.log(100 / self.percent) + 1e-9))

    def windows(self, size: int) -> list[tuple[int, int, int]]:
        """For both pairs of classes that a set takes part in: a number, the fragments and the differing n-grams."""
        out = []
        for w in (self.size_class(size), self.size_class(size) + 1):
            largest = w if self.percent >= 100 else int(math.exp((w + 1) * (math.log(100 / self.percent) + 1e-9))) + 1
            most = self.differing(max(largest, size))
            out.append((w, most + 1 + -(-most // 8 if self.percent >= 85 else -most // 4), most))
        return out


def _sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """The row and the sorted distinct n-grams of each text."""
    for s in slices(column):
        w = find_words(s)
        hashes = hash_words(s, w)
        runs = hashes
        for i in range(1, words):
            runs = chain(runs[:-1], hashes[i:]) if len(runs) > 1 else runs[:0]
        for i in range(s.rows):
            begin, end = int(w.first[i]), int(w.first[i + 1])
            own = runs[begin : end - words + 1] if end - begin >= words else shingle_hashes(hashes[begin:end], words)
            yield s.first_row + i, np.unique(own)


def _prints(grams: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over a set: equal for equal sets, and for others only by a chance below 2 ** -100."""
    one, two = mix(grams ^ np.uint64(0xA0761D6478BD642F)), mix(grams ^ np.uint64(0xE7037ED1A0B428DB))
    return int(one.sum(dtype=np.uint64).view(np.int64)), int(two.sum(dtype=np.uint64).view(np.int64))


def signatures(grams: np.ndarray, t: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each fragment of a set with something in it, in both of its windows; and for each hash its needs.

    ``needs`` is the window's number, shifted by 32 bits, and how many hashes of this window a set over the threshold
    has in common with this one at least: the fragments less those that may differ and those that are empty.
    If so many are empty that nothing might be left, empty fragments have hashes too, and one is enough.
    """
    inner = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams ^ np.uint64(0x8EBC6AF09C88C6E3)), dtype=np.uint64)])
    high = grams >> np.uint64(32)
    out, needs = [], []
    for window, cuts, most in t.windows(len(grams)):
        fragment = ((high * np.uint64(cuts)) >> np.uint64(32)).astype(np.int64)
        begin = np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]]))
        content = inner[np.append(begin[1:], len(grams))] - inner[begin]
        full = fragment[begin]
        need = max(1, len(full) - most)
        if len(full) <= most:
            empty = np.setdiff1d(np.arange(cuts), full)
            full, content = np.concatenate([full, empty]), np.concatenate([content, np.zeros(len(empty), np.uint64)])
        place = mix((full + window * (1 << 40)).astype(np.uint64))
        out.append(chain(place, content))
        needs.append(np.full(len(full), (window << 32) + need, dtype=np.int64))
    return np.concatenate(out), np.concatenate(needs)


def _print_rows(words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(g), *_prints(g)) for _, g in _sets(batch.column("text"), words)]
            n, one, two = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["id", "n", "print1", "print2"]
            )

    return rows


def _signature_rows(t: Threshold):
    """(signature, print1, needs, hits), at most two rows of one batch for a signature.

    Of the classes that meet within the batch in one signature the first and the last are sent. Those between have met
    others already: these hits are summed for each class and window and sent once, under a signature
    of their own and together with a void class, so that they count.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sent, tags, needed = [], [], []
            seen: set[tuple[int, int]] = set()
            for _, grams in _sets(batch.column("text"), t.words):
                both = _prints(grams)
                if len(grams) and both not in seen:  # copies of one batch send theirs once
                    seen.add(both)
                    hashes, needs = signatures(grams, t)
                    sent.append(hashes)
                    needed.append(needs)
                    tags.append(np.full(len(sent[-1]), both[0], dtype=np.int64))
            if not sent:
                continue
            sign, tag, need = np.concatenate(sent), np.concatenate(tags), np.concatenate(needed)
            order = np.lexsort((tag, sign))
            sign, tag, need = sign[order], tag[order], need[order]
            first = np.concatenate([[True], sign[1:] != sign[:-1]])
            ends = first | np.concatenate([first[1:], [True]])
            between, hits = np.unique(np.stack([tag[~ends], need[~ends]]), axis=1, return_counts=True)
            own = chain(mix(between[0].view(np.uint64) ^ np.uint64(0x589965CC75374CC3)), between[1].view(np.uint64))
            void = np.zeros(len(own), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(np.concatenate([sign[ends], own, own]))), pa.array(np.concatenate([tag[ends], between[0], void])),
                    pa.array(np.concatenate([need[ends], between[1], void])),
                    pa.array(np.concatenate([np.ones(int(ends.sum()), np.int64), hits, void])),
                ],
                names=["signature", "print1", "needs", "hits"],
            )

    return rows


def _gram_rows(words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, grams, size = [], [], 0
            for row, g in _sets(batch.column("text"), words):
                prints.append(_prints(g)[0])
                grams.append(signed(g))
                size += len(g)
                if size > 1 << 19 or row + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(prints, pa.int64()), pa.array(grams, type=pa.list_(pa.int64()))], names=["id", "grams"])
                    prints, grams, size = [], [], 0

    return rows


def _bucket(column: Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(1 << MAP_BITS)).cast("int")


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents with one of the ids. A bit map of fixed size drops most others before the join's shuffle."""
    buckets = ids.select(_bucket(F.col("id")).alias("b")).distinct().toArrow()["b"].to_numpy()
    bits = np.zeros(1 << MAP_BITS, dtype=bool)
    bits[buckets] = True
    # a constant of the plan, read without a Python worker beside the one that lists the n-grams
    bitmap, bucket = F.lit(np.packbits(bits).tobytes()), _bucket(F.col("id"))
    byte = F.conv(F.hex(F.substring(bitmap, (bucket / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    listed = F.floor(byte / F.pow(F.lit(2), 7 - bucket % 8)) % 2 == 1
    return docs.where(listed).join(ids, "id", "left_semi")


class _Pairs:
    """Candidate pairs of classes and their test; keeps what it needs in written tables."""

    #: What is known of a class on its own.
    ROW = ("id", "n", "alone", "sizes")

    def __init__(self, sets: DataFrame, t: Threshold):
        spark, self.t = sets.sparkSession, t
        rows = sets.select("id", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
        common = rows.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
        shared = cut_lineage(spark, rows.join(common, "gram").select("id", "n", "gram", "df"), "shared")
        def cut(fragments: int) -> Column:
            return F.shiftrightunsigned("gram", 64 - int(math.log2(fragments))).cast("int")

        self.segments = cut_lineage(
            spark, shared.groupBy("id", cut(FRAGMENTS).alias("fragment")).agg(F.collect_list("gram").alias("segment")), "segments"
        )
        counted = shared.groupBy("id", cut(SIZED).alias("fragment")).agg(F.count("*").cast("int").alias("size"))
        sizes = counted.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("fragment", "size"))).alias("sizes"))
        per_fragment = F.transform(F.sequence(F.lit(0), F.lit(SIZED - 1)), lambda f: F.coalesce(F.try_element_at("sizes", f), F.lit(0)))
        # by df and then by hash; n-grams of no other class stand first and are left out
        gathered = shared.groupBy("id", "n").agg(
            F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("grams"), (F.sum(F.log("df")) / F.first("n")).alias("weight")
        )
        alone = (F.col("n") - F.size("grams")).alias("alone")
        prefix = F.col("n") - F.ceil(F.col("n") * t.percent / 100) + 1 - (F.col("n") - F.size("grams"))
        self.known = cut_lineage(
            spark,
            gathered.where(prefix > 0).select("id", "n", "weight", alone, F.slice("grams", F.lit(1), prefix.cast("int")).alias("prefix"))
            .join(sizes.select("id", per_fragment.alias("sizes")), "id"),
            "known",
        )
        self.postings = cut_lineage(spark, self.known.select(*_Pairs.ROW, "weight", F.explode("prefix.gram").alias("gram")), "postings")

    def _enough(self, overlap: Column, one: str = "n", other: str = "other_n") -> Column:
        return overlap * (100 + self.t.percent) >= (F.col(one) + F.col(other)) * self.t.percent

    def _may_link(self) -> Column:
        """The sizes allow it: the whole ones, those of what each has alone, and the smaller ones of each fragment, summed."""
        p = self.t.percent
        bound = F.aggregate(F.zip_with("sizes", "other_sizes", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
        return (
            (F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * p)
            & ((F.col("alone") + F.col("other_alone")) * (100 + p) <= (F.col("n") + F.col("other_n")) * (100 - p))
            & self._enough(bound)
        )

    def _labelled(self, labels: DataFrame | None) -> DataFrame:
        if labels is None:
            return self.postings.withColumn("component", F.col("id"))
        named = labels.select(F.col("node").alias("id"), "component")
        return self.postings.join(named, "id", "left").withColumn("component", F.coalesce("component", "id"))

    def around_centres(self, labels: DataFrame | None, among_rest: bool) -> DataFrame:
        """Pairs of each class with the most central one that holds an n-gram of its prefix.

        With ``among_rest`` the centre is sought among those that are not connected with that one.
        """
        rows = self._labelled(labels)
        row = F.struct("weight", "id", "component", "n", "alone", "sizes")
        if among_rest:
            first = rows.groupBy(F.col("gram").alias("g")).agg(F.max(row)["component"].alias("first"))
            rows = rows.join(first, F.col("gram") == F.col("g")).where("component != first").select(*rows.columns)
        centres = rows.groupBy(F.col("gram").alias("g")).agg(F.max(row).alias("c"), F.count("*").alias("rows")).where("rows > 1")
        centres = centres.select("g", *[F.col(f"c.{x}").alias(f"other_{x}") for x in (*self.ROW, "component")])
        met = rows.join(centres, (F.col("gram") == F.col("g")) & (F.col("component") != F.col("other_component")) & self._may_link())
        return self._distinct(met)

    def all_apart(self, labels: DataFrame) -> DataFrame:
        """All pairs of classes that share an n-gram of their prefixes and are not connected."""
        rows = self._labelled(labels)
        names = (*self.ROW, "component")
        apart = rows.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("gram")
        rows = cut_lineage(rows.sparkSession, rows.join(apart, "gram").select("gram", *names), "apart")
        others = rows.select(F.col("gram").alias("g"), *[F.col(x).alias(f"other_{x}") for x in names])
        return self._distinct(
            rows.join(others, (F.col("gram") == F.col("g")) & (F.col("component") < F.col("other_component")) & self._may_link())
        )

    @staticmethod
    def _distinct(met: DataFrame) -> DataFrame:
        first = F.col("id") < F.col("other_id")
        both = [F.when(first, F.col(x)).otherwise(F.col(y)) for x, y in (("id", "other_id"), ("other_id", "id"), ("n", "other_n"), ("other_n", "n"))]
        return met.select(*[c.alias(name) for c, name in zip(both, ("a", "b", "n_a", "n_b"))]).distinct()

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose overlap, counted by fragment and summed, reaches the threshold."""
        one = self.segments.select(F.col("id").alias("a"), "fragment", F.col("segment").alias("one"))
        two = self.segments.select(F.col("id").alias("b"), "fragment", F.col("segment").alias("two"))
        partial = pairs.join(one, "a").join(two, ["b", "fragment"]).select(
            "a", "b", "n_a", "n_b", F.size(F.array_intersect("one", "two")).alias("overlap")
        )
        return partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap")).where(self._enough(F.col("overlap"), "n_a", "n_b")).select("a", "b", "overlap")


def near_duplicates(docs: DataFrame, threshold: Threshold = Threshold(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles`` and ``component_id``, the smallest id that links lead to.

    Texts link if 100 x overlap >= percent x union of their distinct n-grams of lower-cased words; a text with fewer
    words is one n-gram. Null texts and texts without words have none and link with nothing. Rows that repeat an id
    are texts of their own. Rows with a null id are returned with a null component.
    Columns other than the two are not read; an empty table gives an empty one.
    """
    spark, t = docs.sparkSession, threshold
    kind = docs.schema[id_column].dataType.simpleString()
    named = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    prints = cut_lineage(
        spark, named.mapInArrow(_print_rows(t.words), f"id {kind}, n bigint, print1 bigint, print2 bigint"), "prints"
    )
    same = ["n", "print1", "print2"]
    classes = prints.where("id is not null and n > 0").groupBy(*same).agg(F.min("id").alias("rep"))
    classes = cut_lineage(spark, classes, "classes")

    # step 1: classes that agree with another in a whole fragment
    sent = named.select("text").mapInArrow(_signature_rows(t), "signature bigint, print1 bigint, needs bigint, hits bigint")
    held = Window.partitionBy("signature")
    met = sent.select("print1", "needs", "hits", F.min("print1").over(held).alias("low"), F.max("print1").over(held).alias("high"))
    often = met.where("low != high").groupBy("print1", "needs").agg(F.sum("hits").alias("hits"))
    enough = F.col("hits") >= F.col("needs").bitwiseAND(F.lit((1 << 32) - 1))
    met = cut_lineage(spark, often.where("needs != 0").where(enough).select("print1").distinct(), "met")

    # steps 2 to 4, on the texts of one id of each class that is left; a class goes by its first print
    left = cut_lineage(spark, classes.join(met, "print1", "left_semi").select(F.col("rep").alias("id")).distinct(), "left")
    grams = _only(named, left).mapInArrow(_gram_rows(t.words), "id bigint, grams array<bigint>")
    linked = _links(cut_lineage(spark, grams.groupBy("id").agg(F.min("grams").alias("grams")), "grams"), t)

    placed = classes.join(linked, F.col("print1") == F.col("node"), "left").withColumn("component", F.coalesce("component", "print1"))
    smallest = placed.groupBy(F.col("component").alias("c")).agg(F.min("rep").alias("component_id"))
    named_class = placed.join(smallest, F.col("component") == F.col("c")).select(*[F.col(x).alias(f"_{x}") for x in same], "component_id")
    on = (F.col("n") == F.col("_n")) & (F.col("print1") == F.col("_print1")) & (F.col("print2") == F.col("_print2"))
    member = prints.join(named_class, on, "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return member.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def _links(grams: DataFrame, t: Threshold) -> DataFrame:
    """``node, component`` of the classes that link, from one row (id, grams) for each."""
    pairs = _Pairs(grams, t)
    labels, links = None, None
    for round_ in range(3):
        tested = pairs.around_centres(labels, among_rest=round_ > 0) if round_ < 2 else pairs.all_apart(labels)
        found = pairs.linked(cut_lineage(grams.sparkSession, tested, "pairs")).select("a", "b")
        links = cut_lineage(grams.sparkSession, found if links is None else links.union(found), "links")
        labels = cut_lineage(grams.sparkSession, components(links), "components")
    return labels
