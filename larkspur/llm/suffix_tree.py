"""Language-model scoring with a probabilistic suffix tree over words.

A node of the tree is a context: the last words before a place, none at the root. Its next-word distribution is
smoothed by absolute discounting: what is taken off the counts, and what belongs to words that are not listed, goes
to the distribution of the context without its first word, and at the root to an unknown word. A context becomes a
state if its distribution differs enough from that of its suffix: the log-likelihood it gains on its
own occurrences must pay for the entries it lists. Suffixes of states are states. A word is scored by the
longest state that ends where it begins.

Counts of words and of runs of words stay in tables, whose rows grow with the corpus: a run is listed if it occurs
``min_count`` times, and discounting, the divergence test and the suffixes are made from these tables. A run is known by a
hash of the runs at its front and at its end that are a word shorter. The parts of a run are listed if it is, so the log
probability of a word is a sum with one term for each length of context that is a state: how much a listed run
gains over its end, or what the context passes on. Every term has a key and is looked up apart from the others.

Only runs and contexts with a share of ``sent_share`` or more go to the driver and, as a ``Tree``, to the tasks: the
shares of one length sum to 1 at most, so there are no more than 1 / ``sent_share`` of them. With them go bit maps of
fixed size over all states and listed runs, which can rule out a run but not confirm it. Terms that both leave
undecided are looked up in the tables: their keys are dealt out by range, as the tables are. So what is sent
decides only how much is looked up. Keys travel in arrays, one row for each range that a task has keys for.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from larkspur.llm.words import Slice, chain, find_words, hash_words, signed, slices
from larkspur.session import cut_lineage, remove_folder, shuffles_dropped, written

#: The hash of the token that ends a text.
END = np.uint64(0x6C8E9CF570932BD5)
#: Distinct keys that a task gathers before it hands them on.
KEYS_KEPT = 1 << 20
#: Tokens learnt from for each task that sums or looks up keys, and ranges of keys for each of these tasks.
TASK_TOKENS = 1 << 20
TASK_RANGES = 4
#: Bytes of text to a token, about; only for the number of tasks.
TOKEN_BYTES = 6
#: Parts of the texts that are scored one after the other, so that the open keys of one are on disk at a time.
SCORED_PARTS = 4
#: What tells the key of a context from that of the same words as a run.
CONTEXT = np.uint64(0x2545F4914F6CDD1D)
#: A bit map of runs has two to the power of this many bits at most, and no more than ``SIEVE_ROOM`` to 2 * ``SIEVE_ROOM`` for each run.
SIEVE_BITS = 27
SIEVE_ROOM = 16


class Settings(NamedTuple):
    """Words of the longest context, least share of a listed run (and least count), discount, and the divergence test:
    nats that a state must gain per listed entry, and per occurrence. ``sent_share`` is that of a run sent to the tasks."""

    depth: int = 2
    min_share: float = 0.0
    min_count: int = 2
    discount: float = 0.5
    entry_cost: float = 2.0
    min_divergence: float = 0.005
    sent_share: float = 5e-7


class Tokens(NamedTuple):
    """Hashes of all tokens of some texts, the end of each included, and where each text's begin (and the last end)."""

    hashes: np.ndarray
    first: np.ndarray


class Tree(NamedTuple):
    """What is sent: words with their counts and log10 probabilities at the root, and contexts and runs by the length of the context.

    All keys are sorted. ``contexts`` has keys, whether they are states, and the log10 of what they pass on; ``runs`` the keys of those
    listed in states, and the log10 of their gain. ``sieves`` has for each length the bit maps of states and of runs listed in them; none if all is sent.
    """

    words: np.ndarray
    counts: np.ndarray
    log_p: np.ndarray
    contexts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    runs: list[tuple[np.ndarray, np.ndarray]]
    tokens: int
    vocabulary: int
    discount: float
    sieves: list[tuple[np.ndarray, np.ndarray]]

    def unseen(self) -> float:
        """The log10 probability of the unknown word at the root."""
        return float(np.log10(self.discount * self.vocabulary / self.tokens)) if self.tokens else 0.0


def tokens_of(s: Slice) -> Tokens:
    w = find_words(s)
    first = w.first + np.arange(s.rows + 1)
    out = np.empty(int(first[-1]), dtype=np.uint64)
    is_end = np.zeros(len(out), dtype=bool)
    is_end[first[1:] - 1] = True
    out[is_end], out[~is_end] = END, hash_words(s, w)
    return Tokens(out, first)


def _lookup(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The index of each value in the sorted keys, or -1. Looked up in order, which reads memory in order."""
    out = np.full(len(values), -1, dtype=np.int64)
    if not len(keys) or not len(values):
        return out
    order = np.argsort(values)
    sorted_values = values[order]
    at = np.minimum(np.searchsorted(keys, sorted_values), len(keys) - 1)
    out[order] = np.where(keys[at] == sorted_values, at, -1)
    return out


def _before(keys: np.ndarray) -> np.ndarray:
    """For each token what the one before it has; of use only behind the begin of a text."""
    return np.concatenate([keys[:1], keys[:-1]])


def _place(t: Tokens) -> np.ndarray:
    """For each token how many there are before it in its text."""
    return np.arange(len(t.hashes)) - np.repeat(t.first[:-1], np.diff(t.first))


def _longer(keys: np.ndarray) -> np.ndarray:
    """The keys of the runs that end at each token and are a word longer than those of ``keys``."""
    return chain(_before(keys), keys)


def _seen(sieve: np.ndarray, key: np.ndarray) -> np.ndarray:
    bits = len(sieve).bit_length() + 5
    key = key >> np.uint64(64 - bits)
    return (sieve[(key >> np.uint64(6)).astype(np.int64)] >> (key & np.uint64(63))) & np.uint64(1) != 0


def _sieve(runs: DataFrame) -> np.ndarray:
    """The bit map of the keys in a table: up to 2 ** ``SIEVE_BITS`` bits, however many there are."""
    bits = min(SIEVE_BITS, max(6, (SIEVE_ROOM * runs.count()).bit_length()))
    key = F.shiftrightunsigned("key", 64 - bits)
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    found = runs.select(key.alias("place")).groupBy(F.shiftright("place", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


class Deal(NamedTuple):
    """In how many tasks keys meet, and in how many ranges (a power of two) they are dealt out."""

    tasks: int
    bits: int

    def ranges(self, key: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
        """The columns, each cut into one array for each range of keys that is not empty."""
        order = np.argsort(key)
        edges = np.searchsorted(key[order], np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits))
        edges = np.append(edges, len(key))
        full = np.flatnonzero(np.diff(edges))
        offsets = pa.array(np.append(edges[full], len(key)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in columns.values()]
        return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), *lists], names=["range", *columns])


def _deal(tokens: int) -> Deal:
    tasks = 1 + tokens // TASK_TOKENS
    return Deal(tasks, (TASK_RANGES * tasks).bit_length())


def _flat(batches: list[pa.RecordBatch], name: str) -> np.ndarray:
    """The arrays of a column, one after the other."""
    return np.concatenate([x.column(name).flatten().to_numpy(zero_copy_only=False) for x in batches])


def _in_parts(names: list[str], columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(x[at : at + (1 << 16)]) for x in columns], names=names)


def _tally(lengths: list[int], listed, deal: Deal):
    """Counts of the runs of so many words of all texts, summed within the task as far as memory allows.

    ``listed`` is a bit map of the runs that are a word shorter, or None: a run with a part that it rules out is left away.
    A word alone is its own ``ctx``.
    """

    def found(t: Tokens, length: int) -> tuple[np.ndarray, ...]:
        if length == 1:
            key, count = np.unique(t.hashes, return_counts=True)
            return key, key, np.zeros(len(key), dtype=np.uint64), count
        low = t.hashes
        for _ in range(length - 2):
            low = _longer(low)
        context = _before(low)
        at = np.flatnonzero(_place(t) >= length - 1)
        context, low = context[at], low[at]
        if listed is not None:
            kept = _seen(listed.value, context)
            kept[kept] = _seen(listed.value, low[kept])
            context, low = context[kept], low[kept]
        key, first, count = np.unique(chain(context, low), return_index=True, return_counts=True)
        return key, context[first], low[first], count

    def summed(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        key, context, low, count = (np.concatenate(x) for x in zip(*held))
        _, at, place = np.unique(key, return_index=True, return_inverse=True)
        return key[at], context[at], low[at], np.bincount(place, weights=count, minlength=len(at)).astype(np.int64)

    def out(length: int, key: np.ndarray, context: np.ndarray, low: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        made = deal.ranges(key, {"ctx": signed(context), "low": signed(low), "count": count})
        return made.append_column("length", pa.array(np.full(made.num_rows, length, dtype=np.int32)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, ...]]] = {x: [] for x in lengths}
        size = dict.fromkeys(lengths, 0)
        for batch in batches:
            for s in slices(batch.column("text")):
                t = tokens_of(s)
                for x in lengths:
                    held[x].append(found(t, x))
                    size[x] += len(held[x][-1][0])
                    if size[x] > 2 * KEYS_KEPT:
                        held[x] = [summed(held[x])]
                        size[x] = len(held[x][0][0])
                        if size[x] > KEYS_KEPT:
                            yield out(x, *held[x].pop())
                            size[x] = 0
        for x in lengths:
            if held[x]:
                yield out(x, *summed(held[x]))

    return rows


def _add_up(least: float):
    """The sums of the counts of a range's runs: of all words, and of those longer ones that reach ``least``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            for x in pc.unique(batch.column("length")).to_pylist():
                held.setdefault(x, []).append(batch.filter(pc.equal(batch.column("length"), x)))
        for x, parts in held.items():
            context, low, count = (_flat(parts, name) for name in ("ctx", "low", "count"))
            key = context.view(np.uint64) if x == 1 else chain(context.view(np.uint64), low.view(np.uint64))
            order = np.argsort(key)
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            total = np.add.reduceat(count[order], first)
            if x > 1:
                first, total = first[total >= least], total[total >= least]
            length = np.full(len(first), x, dtype=np.int32)
            yield from _in_parts(["length", "ctx", "low", "count"], [length, context[order[first]], low[order[first]], total])

    return rows


def _counted(texts: DataFrame, lengths: list[int], listed, deal: Deal, least: float) -> DataFrame:
    """The runs of so many words with their counts; and the keys of the runs a word shorter at their fronts and ends."""
    dealt = texts.mapInArrow(_tally(lengths, listed, deal), "range int, ctx array<bigint>, low array<bigint>, count array<bigint>, length int")
    return dealt.repartition(deal.tasks, "range").mapInArrow(_add_up(least), "length int, ctx bigint, low bigint, count bigint")


def _smoothed(cfg: Settings, sent: float, last: bool):
    """The entries of ``smooth`` for whole contexts: their runs with ``low_p``, and a row with the count of each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [x for x in batches if x.num_rows]
        if not held:
            return
        got = pa.Table.from_batches(held)
        ctx, low, count, low_p = (got[x].to_numpy() for x in ("ctx", "low", "count", "low_p"))
        is_run = ~got["is_context"].to_numpy()
        at = np.flatnonzero(~is_run)
        at = at[np.argsort(ctx[at].view(np.uint64))]
        contexts, suffix, total = ctx[at], low[at], count[at]
        ctx, low, count, low_p = (x[is_run] for x in (ctx, low, count, low_p))
        of, n = _lookup(contexts.view(np.uint64), ctx.view(np.uint64)), len(contexts)
        entries = np.bincount(of, minlength=n)
        unlisted = total - np.bincount(of, weights=count, minlength=n)
        rest = (unlisted + cfg.discount * entries) / total
        p = (count - cfg.discount) / total[of] + rest[of] * low_p
        ratio = np.log(np.maximum(p, 1e-300)) - np.log(np.maximum(low_p, 1e-300))
        passed = np.log(np.maximum(rest, 1e-300))
        gain = np.bincount(of, weights=count * ratio, minlength=n) + unlisted * passed
        state = (gain >= cfg.entry_cost * entries) & (gain >= cfg.min_divergence * total)
        key = signed(chain(ctx.view(np.uint64), low.view(np.uint64)))
        value, in_state = (ratio - passed[of]) / np.log(10), state[of]
        used = np.flatnonzero((entries > 0) & (state | (total >= sent) | (not last)))
        none, zero = np.zeros(len(key), dtype=np.int64), np.zeros(len(used))
        kept = in_state if last else np.ones(len(key), dtype=bool)
        runs = [key, none, none, count, none.astype(float), value, in_state, none.astype(bool)] if last else [key, ctx, low, count, p, value, in_state, none.astype(bool)]
        names = ["key", "ctx", "low", "count", "p", "value", "state", "is_context"]
        yield from _in_parts(names, [x[kept] for x in runs])
        yield from _in_parts(names, [contexts[used], contexts[used], suffix[used], total[used], zero, passed[used] / np.log(10), state[used], ~zero.astype(bool)])

    return rows


def smooth(runs: DataFrame, shorter: DataFrame, cfg: Settings, sent: float, last: bool) -> DataFrame:
    """The listed runs of a length, and a row for each of their contexts (``is_context``).

    ``shorter`` has the listed runs that are a word shorter, with ``count`` and ``p``. A run has the probability ``p`` of its last word after
    the others and as ``value`` the log10 of its gain over the run without its first word, less what its context passes on. A
    context has that as its value, and in ``low`` its suffix. ``state`` is the divergence of the context alone. Of the
    ``last`` length only what a term may need is kept: runs in states, states, and contexts that are sent.
    """
    ends = runs.join(shorter.select(F.col("key").alias("low"), F.col("p").alias("low_p")), "low")
    entries = ends.select("ctx", "low", "count", "low_p", F.lit(False).alias("is_context"))
    totals = shorter.select(F.col("key").alias("ctx"), "low", "count", F.lit(0.0).alias("low_p"), F.lit(True).alias("is_context"))
    schema = "key bigint, ctx bigint, low bigint, count bigint, p double, value double, state boolean, is_context boolean"
    return entries.unionByName(totals).repartition("ctx").mapInArrow(_smoothed(cfg, sent, last), schema)


def _sorted(of: DataFrame, *columns: str) -> tuple[np.ndarray, ...]:
    """The keys of a table in order, and its columns."""
    got = of.select("key", *columns).toArrow()
    key = got["key"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    return key[order], *[got[c].to_numpy()[order] for c in columns]


class Index(NamedTuple):
    """A tree's keys by length of run: those of runs listed in states and those of contexts in one order, with the places of both or -1."""

    keys: list[np.ndarray]
    runs: list[np.ndarray]
    contexts: list[np.ndarray]


def _index(tree: Tree) -> Index:
    empty = np.zeros(0, dtype=np.uint64)
    runs, contexts = [tree.words, *[x[0] for x in tree.runs]], [*[x[0] for x in tree.contexts], empty]
    keys = [np.union1d(x, y) for x, y in zip(runs, contexts)]
    return Index(keys, *[[_lookup(x, y).astype(np.int32) for x, y in zip(of, keys)] for of in (runs, contexts)])


def _at(places: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The places at an index, -1 where that is -1."""
    out = np.full(len(index), -1, dtype=np.int64)
    known = index >= 0
    out[known] = places[index[known]]
    return out


def _terms(t: Tokens, tree: Tree, index: Index) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """For each token the sum of the log10 terms that the tree decides, and its place among the words that are sent, or -1.

    The last part has the tokens and keys of the terms that it leaves open.
    """
    here = _lookup(index.keys[0], t.hashes)
    word = _at(index.runs[0], here)
    rare = np.flatnonzero(word < 0)
    log_p = np.full(len(word), tree.unseen())
    log_p[word >= 0] = tree.log_p[word[word >= 0]]
    left = [(rare, t.hashes[rare])]
    at, keys = np.arange(len(word)), t.hashes
    place = _place(t)
    for k, ((_, states, passed), (_, gain)) in enumerate(zip(tree.contexts, tree.runs)):
        at = at[place[at] > k]  # only where the shorter context may be a state
        found = _at(index.contexts[k], here[at - 1])
        is_state = found >= 0
        is_state[is_state] = states[found[is_state]]
        some = is_state.copy()
        if tree.sieves:
            unknown = np.flatnonzero(found < 0)
            unknown = unknown[_seen(tree.sieves[k][0], keys[at[unknown] - 1])]
            some[unknown] = True
            left.append((at[unknown], keys[at[unknown] - 1] ^ CONTEXT))
        log_p[at[is_state]] += passed[found[is_state]]
        keys = _longer(keys)
        at = at[some]
        # all places behind these runs may ask for them as contexts
        follow = np.flatnonzero(place > k) if k + 1 < len(tree.contexts) else at
        here = np.full(len(word), -1, dtype=np.int64)
        here[follow] = _lookup(index.keys[k + 1], keys[follow])
        run = _at(index.runs[k + 1], here[at])
        log_p[at[run >= 0]] += gain[run[run >= 0]]
        if tree.sieves:
            open_at = at[run < 0]
            open_at = open_at[_seen(tree.sieves[k][1], keys[open_at])]
            left.append((open_at, keys[open_at]))
    return log_p, word, left


def score_tokens(t: Tokens, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """For each token the log10 probability as far as the tree tells it, without what the root gives to a word that is not sent; and whether it is one."""
    log_p, word, _ = _terms(t, tree, _index(tree))
    return np.where(word < 0, log_p - tree.unseen(), log_p), word < 0


ASK_SCHEMA = "range int, row bigint, id {kind}, learnt boolean, n_tokens bigint, n_known bigint, base double, log_p double, keys array<bigint>, at array<smallint>, value array<double>, count array<bigint>"


def _ask(shared, deal: Deal, schema: pa.Schema):
    """A row for each text with all that the tree decides, and rows with the keys of all open terms, dealt out by range.

    Open keys come with the place of their text behind the text numbered ``row``.
    """

    def full(batch: dict[str, pa.Array], n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch[f.name].cast(f.type) if f.name in batch else pa.nulls(n, f.type) for f in schema], schema=schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, index = shared.value
        base_of = np.append(np.log10(tree.counts + 1.0), 0.0)
        row = first = TaskContext.get().partitionId() << 36
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def out() -> pa.RecordBatch:
            keys, at = (np.concatenate(x) for x in zip(*held))
            made = deal.ranges(keys, {"keys": signed(keys), "at": at.astype(np.int16)})
            n = made.num_rows
            return full({x: made.column(x) for x in ("range", "keys", "at")} | {"row": pa.array(np.full(n, first))}, n)

        for batch in batches:
            for s in slices(batch.column("text")):
                t = tokens_of(s)
                log_p, word, left = _terms(t, tree, index)
                text = np.repeat(np.arange(s.rows), np.diff(t.first))
                rare = word < 0
                n = np.diff(t.first)
                yield full({
                    "range": pa.array(((row + np.arange(s.rows)) % (1 << deal.bits)).astype(np.int32)), "row": pa.array(row + np.arange(s.rows)),
                    "id": batch.column("id").slice(s.first_row, s.rows), "learnt": batch.column("learnt").slice(s.first_row, s.rows),
                    "n_tokens": pa.array(n), "n_known": pa.array(n - np.add.reduceat(rare.astype(np.int64), t.first[:-1])),
                    "base": pa.array(np.add.reduceat(base_of[word], t.first[:-1])), "log_p": pa.array(np.add.reduceat(log_p, t.first[:-1])),
                }, s.rows)
                if row + s.rows - first > 1 << 15 and held:  # places are short numbers
                    yield out()
                    held, size, first = [], 0, row
                for at, keys in left:
                    held.append((keys, row - first + text[at]))
                    size += len(keys)
                row += s.rows
                if size > KEYS_KEPT:
                    yield out()
                    held, size, first = [], 0, row
        if size:
            yield out()

    return rows


def _table(deal: Deal):
    """Keys with value and count, dealt out by range."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            key, value, count = (np.concatenate([x.column(name).to_numpy() for x in held]) for name in ("key", "value", "count"))
            return deal.ranges(key.view(np.uint64), {"keys": key, "value": value, "count": count})

        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size > KEYS_KEPT:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    return rows


PART = ["row", "id", "learnt", "n_tokens", "n_known", "base", "log_p"]


def _answer(schema: pa.Schema):
    """The rows of texts as they are; and for each text the sums of the terms that are found in the table's rows of the same ranges."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: list[pa.RecordBatch] = []
        asked: list[tuple[int, np.ndarray, np.ndarray]] = []
        for batch in batches:
            is_text, is_table = pc.is_valid(batch.column("n_tokens")), pc.is_valid(batch.column("value"))
            texts = batch.filter(is_text)
            if texts.num_rows:
                yield texts.select(PART)
            if pc.any(is_table).as_py():
                table.append(batch.filter(is_table).select(["keys", "value", "count"]))
            asks = batch.filter(pc.invert(pc.or_(is_text, is_table))).select(["row", "keys", "at"])
            for i in range(asks.num_rows):
                part = asks.slice(i, 1)
                asked.append((part.column("row")[0].as_py(), part.column("keys").flatten().to_numpy(), part.column("at").flatten().to_numpy()))
        if not table or not asked:
            return
        keys, value, count = (_flat(table, x) for x in ("keys", "value", "count"))
        keys = keys.view(np.uint64)
        order = np.argsort(keys)
        keys, value, count = keys[order], value[order], count[order]
        base = np.log10(count + 1.0)
        by_row: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for row, of, at in asked:
            by_row.setdefault(row, []).append((of, at))
        for row, parts in by_row.items():  # the keys of one row come from the same texts
            of, at = (np.concatenate(x) for x in zip(*parts))
            found = _lookup(keys, of.view(np.uint64))
            at, found = at[found >= 0], found[found >= 0]
            if not len(at):
                continue
            text, place = np.unique(at, return_inverse=True)
            n = len(text)
            sums = [np.bincount(place, weights=x[found], minlength=n) for x in (count > 0, base, value)]
            got = {"row": pa.array(row + text.astype(np.int64)), "n_known": pa.array(sums[0].astype(np.int64)), "base": pa.array(sums[1]), "log_p": pa.array(sums[2])}
            yield pa.RecordBatch.from_arrays([got[f.name] if f.name in got else pa.nulls(n, f.type) for f in schema], schema=schema)

    return rows


class Model(NamedTuple):
    """What is sent to the tasks, and the tables: words (key, count, p), and the terms (key, value, count) of all that is not sent."""

    tree: Tree
    words: DataFrame
    terms: DataFrame
    folders: list[str]


def learn(texts: DataFrame, settings: Settings = Settings()) -> Model:
    """The model learnt from the column ``text``. Its tables are read from the folders that are named in it."""
    spark, cfg = texts.sparkSession, settings
    deal = _deal((texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // TOKEN_BYTES)
    runs = written(spark, _counted(texts, [1, 2], None, deal, float(cfg.min_count)), "counts")
    total = runs.frame.where("length = 1").agg(F.sum("count").alias("n"), F.count("*").alias("v")).first()
    n, v = total["n"] or 0, total["v"]
    least = float(max(cfg.min_count, cfg.min_share * n))
    sent = max(least, cfg.sent_share * n)
    words = written(spark, runs.frame.where("length = 1").select(F.col("ctx").alias("key"), "count"), "words")
    folders = [words.folder]
    all_words = words.frame.select("key", F.lit(0).cast("bigint").alias("low"), "count", ((F.col("count") - cfg.discount) / F.lit(float(max(n, 1)))).alias("p"))
    shorter = all_words.where(F.col("count") >= least)
    tables: list[DataFrame] = []
    for length in range(2, cfg.depth + 2):
        if length > 2:
            listed = spark.sparkContext.broadcast(_sieve(shorter))
            runs = written(spark, _counted(texts, [length], listed, deal, least), "counts")
            listed.destroy()
        of_length = runs.frame.where((F.col("length") == length) & (F.col("count") >= least))
        smoothed = written(spark, smooth(of_length, shorter, cfg, sent, length == cfg.depth + 1), "runs")
        remove_folder(spark, runs.folder)
        folders.append(smoothed.folder)
        tables.append(smoothed.frame)
        shorter = smoothed.frame.where("not is_context")

    states = [x.where("state") for x in tables]
    closed: list[np.ndarray] = [np.zeros(0, dtype=np.uint64)] * cfg.depth
    often = F.col("count") >= F.lit(float(sent))
    for k in range(cfg.depth - 2, -1, -1):  # a state's suffix is a state
        longer = states[k + 1].where("is_context").select(F.col("low").alias("ctx")).distinct()
        more = written(spark, tables[k].where("not state").join(longer, "ctx", "left_semi").select(*tables[k].columns), "closed")
        folders.append(more.folder)
        closed[k] = _sorted(more.frame.where("is_context").where(often))[0]
        states[k] = states[k].unionByName(more.frame)

    sieves, contexts, gains = [], [], []
    log_p = F.log10(F.greatest("p", F.lit(1e-300)))
    key, count, sent_log_p = _sorted(all_words.where(often).withColumn("log_p", log_p), "count", "log_p")
    unseen = Tree(key, count, sent_log_p, [], [], n, v, cfg.discount, []).unseen()  # what a word has until it is found
    terms = all_words.where(~often).select("key", (log_p - F.lit(unseen)).alias("value"), "count")
    for k, (every, state) in enumerate(zip(tables, states)):
        known, is_state, passed = _sorted(every.where("is_context").where(often), "state", "value")
        contexts.append((known, is_state | np.isin(known, closed[k]), passed))
        of_state, listed = state.where("is_context"), state.where("not is_context")
        gains.append(_sorted(listed.where(often), "value"))
        if sent > least:
            sieves.append((_sieve(of_state), _sieve(listed)))
        none = F.lit(0).cast("bigint").alias("count")
        apart = F.col("key").bitwiseXOR(F.lit(int(CONTEXT.view(np.int64)))).alias("key")
        terms = terms.unionByName(of_state.where(~often).select(apart, "value", none)).unionByName(listed.where(~often).select("key", "value", none))
    # a run's value is less what its context passes on, which is a term of its own; together they are the run's gain
    tree = Tree(key, count, sent_log_p, contexts, gains, n, v, cfg.discount, sieves)
    return Model(tree, all_words, terms, folders)


def fit(texts: DataFrame, settings: Settings = Settings()) -> tuple[Tree, DataFrame]:
    """The tree that is sent, learnt from the column ``text``, and the table (key, count, p) of all words."""
    model = learn(texts, settings)
    return model.tree, model.words


def score(docs: DataFrame, train: Column, id_column: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The tree learns from the rows for which ``train`` is true. A text's tokens are its lower-cased words and one end, so
    a null or empty text has one token. ``base_score`` is the add-one unigram log10 probability, ``score`` that of
    the tree. Without any training rows both are 0, for the unknown word is all there is. Rows are scored one by
    one: ids may be null or repeat. Columns other than those named are not read.
    """
    with shuffles_dropped(docs.sparkSession):
        return _scored(docs, train, id_column, text, settings)


def _scored(docs: DataFrame, train: Column, id_column: str, text: str, settings: Settings) -> DataFrame:
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    named = docs.select(F.col(id_column).alias("id"), F.coalesce(train, F.lit(False)).alias("learnt"), F.col(text).alias("text"))
    model = learn(named.where("learnt").select("text"), settings)
    tree, deal = model.tree, _deal(model.tree.tokens)
    # what is still looked up, in a table of its own
    terms = written(spark, model.terms.mapInArrow(_table(deal), "range int, keys array<bigint>, value array<double>, count array<bigint>"), "terms")
    for folder in model.folders:
        remove_folder(spark, folder)
    none = np.zeros(0, dtype=np.uint64)  # the keys go with the index
    bare = tree._replace(words=none, contexts=[(none, *x[1:]) for x in tree.contexts], runs=[(none, x[1]) for x in tree.runs])
    shared = spark.sparkContext.broadcast((bare, _index(tree)))
    schema = StructType.fromDDL(ASK_SCHEMA.format(kind=kind))
    of_part = StructType([schema[x] for x in PART])
    size = F.log10(F.lit(float(tree.tokens + tree.vocabulary + 1)))
    parts = SCORED_PARTS if deal.tasks > 1 else 1
    scored = []
    for i in range(parts):
        some = named.where(F.pmod(F.xxhash64(F.col("id").cast("string"), "text"), F.lit(parts)) == i) if parts > 1 else named
        asked = some.mapInArrow(_ask(shared, deal, to_arrow_schema(schema)), schema)
        met = asked.unionByName(terms.frame, allowMissingColumns=True).repartition(deal.tasks, "range")
        sums = met.mapInArrow(_answer(to_arrow_schema(of_part)), of_part).groupBy("row").agg(
            F.first("id", ignorenulls=True).alias("id"), F.first("learnt", ignorenulls=True).alias("learnt"),
            F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base"), F.sum("log_p").alias("log_p"),
        )
        scored.append(cut_lineage(spark, sums.select(
            F.col("id").alias(id_column), (~F.col("learnt")).alias("held_out"), "n_tokens",
            "n_known", F.lit(tree.tokens).cast("bigint").alias("train_tokens"),
            (F.col("base") - F.col("n_tokens") * size).alias("base_score"), F.col("log_p").alias("score"),
        ), "scored"))
    shared.destroy()
    remove_folder(spark, terms.folder)
    return reduce(DataFrame.unionByName, scored)
