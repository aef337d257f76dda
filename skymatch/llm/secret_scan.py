"""Secret scans: base patterns, and tokens whose format is that of the credentials which the base patterns label.

One scan of the texts finds the base spans and every candidate: a run of 12 or more characters that tokens are made of. What the patterns label are the
examples: per kind, and for unlabelled candidates as background, a prefix tree over classes of characters is merged, state by state, wherever ends and next
classes agree within a Hoeffding bound (probabilistic grammar inference). A candidate is scored by its mean log-odds against the background under the best
automaton; a span is added where that is as high as for all but a fiftieth of the examples kept aside, and the odds are large in all.

Examples are all distinct values of all documents, none is left out. Their prefixes are counted by Spark; of the prefix tree, what at least one in ``PATHS``
examples of its kind goes through is merged (all of it up to ``PATHS`` examples). Then all examples run through the automaton, and what goes on where it has no
way yet is counted and merged in its turn, until no such way is that frequent; a rarer class leads nowhere else. States are told apart within ``DEPTH`` characters. The
probabilities are those of all whole examples run through the finished automaton, thresholds are exact quantiles over all examples kept aside. Without
``LEAST_EXAMPLES`` of a kind it has no automaton.

Rows: one per row of documents, repeated rows and rows without doc_id too; a null text is empty. Positions are code points. Other columns are not read, so
their names can't clash. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

KINDS = ("assign", "access", "hex")
FOUND = "format"
BACKGROUND = "background"
NAMES = (*KINDS, BACKGROUND)
#: One in how many examples may make a path of the tree; characters within which states are told apart; fewest values.
PATHS = 4_096
DEPTH = 128
LEAST_EXAMPLES = 40
#: Significance of the Hoeffding bound, pseudo-count of what a state has not seen, fewest nats of odds in all.
ALPHA = 0.01
UNSEEN = 0.1
LEAST_ODDS = 12.0

# The patterns of the base kinds and their least lengths.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_.=-]{12,}")

_CONTINUATION = bytes(range(0x80, 0xC0))
#: Classes of characters, the alphabet of the automata.
CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+", "/", "_", ".", "=", "-")
END = len(CLASSES)
#: Stands for the end of an example that goes on beyond ``DEPTH``.
CUT = END + 1
_CLASS_OF = np.zeros(256, dtype=np.int64)
for _i, _chars in enumerate(CLASSES):
    _CLASS_OF[list(_chars.encode())] = _i


def base_spans(text: bytes) -> list[tuple[int, int, int, bytes]]:
    """Kind, start, end (bytes) and labelled value of all base spans, by start and kind."""
    out = []
    lowered = text.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return [(kind, start, end, value) for start, kind, end, value in sorted(out)]


def _points(text: bytes, offsets: list[int]) -> list[int]:
    """Code points before each of these ascending byte offsets."""
    if text.isascii():
        return offsets
    out, at, points = [], 0, 0
    for offset in offsets:
        points += len(text[at:offset].translate(None, _CONTINUATION))
        at = offset
        out.append(points)
    return out


_FINDS = pa.schema([
    ("doc_id", pa.int64()), ("kinds", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("vals", pa.list_(pa.binary())), ("cand_starts", pa.list_(pa.int64())), ("cands", pa.list_(pa.binary())),
])
_FINDS_DDL = "doc_id long, kinds array<int>, starts array<long>, ends array<long>, vals array<binary>, cand_starts array<long>, cands array<binary>"


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list] = [[] for _ in _FINDS.names[1:]]
        for value in batch.column(1):
            text = value.as_py() or b""
            base = base_spans(text)
            taken = sorted((s, e) for _, s, e, _ in base)
            cands, i, reach = [], 0, 0
            for m in CANDIDATE.finditer(text):
                while i < len(taken) and taken[i][0] < m.end():
                    reach = max(reach, taken[i][1])
                    i += 1
                if reach <= m.start():  # apart from all base spans
                    cands.append((m.start(), m[0]))
            order = sorted({x for _, s, e, _ in base for x in (s, e)} | {s for s, _ in cands})
            at = dict(zip(order, _points(text, order), strict=True))
            row = ([k for k, *_ in base], [at[s] for _, s, _, _ in base], [at[e] for _, _, e, _ in base], [v for *_, v in base], [at[s] for s, _ in cands], [c for _, c in cands])
            for column, x in zip(columns, row, strict=True):
                column.append(x)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(_FINDS)[1:], strict=True))], schema=_FINDS)


def finds(docs: DataFrame) -> DataFrame:
    """Base spans and candidates of every row, positions in code points."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(_scan, _FINDS_DDL)


# --- automata ----------------------------------------------------------------------------------------------------


@dataclass
class Automaton:
    """A probabilistic automaton over classes: arrivals, and counts and targets of the next class (``END`` for the end) per state."""

    arrivals: list[int] = field(default_factory=lambda: [0])
    counts: list[dict[int, int]] = field(default_factory=lambda: [{}])
    targets: list[dict[int, int]] = field(default_factory=lambda: [{}])

    def add(self, classes: Iterable[int]) -> None:
        """One example of the prefix tree."""
        state = 0
        self.arrivals[0] += 1
        for c in classes:
            self.counts[state][c] = self.counts[state].get(c, 0) + 1
            if c not in self.targets[state]:
                self.targets[state][c] = len(self.arrivals)
                self.arrivals.append(0)
                self.counts.append({})
                self.targets.append({})
            state = self.targets[state][c]
            self.arrivals[state] += 1
        self.counts[state][END] = self.counts[state].get(END, 0) + 1

    def compatible(self, a: int, b: int, bound: float) -> bool:
        """Do all frequencies of two states, and of the states that they reach by the same classes, agree within the bound?"""
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            n, m = self.arrivals[a], self.arrivals[b]
            most = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if most < 1:
                for c in self.counts[a].keys() | self.counts[b].keys():
                    if abs(self.counts[a].get(c, 0) / n - self.counts[b].get(c, 0) / m) > most:
                        return False
            waiting += [(self.targets[a][c], t) for c, t in self.targets[b].items() if c in self.targets[a]]
        return True

    def fold(self, a: int, b: int) -> None:
        """Add the tree at ``b`` to the state ``a``."""
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            self.arrivals[a] += self.arrivals[b]
            for c, n in self.counts[b].items():
                self.counts[a][c] = self.counts[a].get(c, 0) + n
            for c, t in self.targets[b].items():
                if c in self.targets[a]:
                    waiting.append((self.targets[a][c], t))
                else:
                    self.targets[a][c] = t

    def merge(self, alpha: float = ALPHA, settled: int = 1) -> list[int]:
        """Merge compatible states, breadth first from the first ``settled`` ones (the root); the states that stay."""
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        settled = list(range(settled))
        known = set(settled)
        edge = [(s, c) for s in settled for c in sorted(self.targets[s]) if self.targets[s][c] not in known]
        while edge:
            state, c = edge.pop(0)
            new = self.targets[state][c]
            if new in known:
                continue
            same = next((s for s in settled if self.compatible(s, new, bound)), None)
            if same is None:
                settled.append(new)
                known.add(new)
                edge += [(new, x) for x in sorted(self.targets[new])]
            else:
                self.targets[state][c] = same
                self.fold(same, new)
                # what the fold hung on settled states is looked at in its turn
                edge += [(s, x) for s in settled for x in sorted(self.targets[s]) if self.targets[s][x] not in known and (s, x) not in edge]
        return settled

    def arrays(self, states: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """[state, class or end]: counts, and targets (-1 for none)."""
        number = {s: i for i, s in enumerate(states)}
        counts, targets = np.zeros((len(states), END + 1), dtype=np.int64), np.full((len(states), END + 1), -1)
        for s, i in number.items():
            for c, n in self.counts[s].items():
                counts[i, c] = n
            for c, t in self.targets[s].items():
                targets[i, c] = number[t]
        return counts, targets

    def tables(self, states: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """[state, class or end]: log-probabilities and targets."""
        return _tables(*self.arrays(states))


def _tables(counts: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities with pseudo-counts, and targets; an unseen class leads nowhere else."""
    logs = np.log((counts + UNSEEN) / (counts.sum(axis=1, keepdims=True) + UNSEEN * (END + 1)))
    return logs, np.where(targets < 0, np.arange(len(targets))[:, None], targets)


def learn(values: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tables of the automaton merged from the whole tree of these values; their order does not matter."""
    tree = Automaton()
    for value in sorted(values):
        tree.add(_CLASS_OF[np.frombuffer(value[:DEPTH], np.uint8)].tolist())
    return tree.tables(tree.merge())


_CLASS_BYTES = bytes(_CLASS_OF.astype(np.uint8))
_HEAD = 3  # bytes of kind and state before the classes
_COUNTS = [f"n{c}" for c in range(END + 1)]


def _padded(seqs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows of an array, and their lengths."""
    length = np.array([len(x) for x in seqs], dtype=np.int64)
    out = np.full((len(seqs), length.max(initial=0)), 255, dtype=np.uint8)
    out[np.arange(out.shape[1]) < length[:, None]] = np.frombuffer(b"".join(seqs), np.uint8)
    return out, length


def _frontier(automata: dict[int, tuple[np.ndarray, np.ndarray]]):
    """Of every example that leaves the automaton of its kind: kind, state, the classes from there on and how it ends, as one byte string."""

    def leave(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, out = batch.column(0).to_numpy(), []
            values = batch.column(1).to_pylist()
            for kind, (_, targets) in automata.items():
                seqs = [v[:DEPTH].translate(_CLASS_BYTES) + bytes([END if len(v) <= DEPTH else CUT]) for v in (values[i] for i in np.flatnonzero(kinds == kind))]
                rows, length = _padded(seqs)
                state, active = np.zeros(len(seqs), dtype=np.int64), np.arange(len(seqs))
                for i in range(rows.shape[1]):
                    active = active[length[active] > i + 1]
                    to = targets[state[active], rows[active, i]]
                    out += [bytes([kind]) + int(state[r]).to_bytes(_HEAD - 1, "big") + seqs[r][i:] for r in active[to < 0]]
                    active = active[to >= 0]
                    state[active] = to[to >= 0]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["seq"])

    return leave


def _prefixes(least: list[int]):
    """Of sorted different strings with their numbers: prefixes that ``least`` (by kind) go through, with the counts of what comes next. A prefix that also stands at an
    end of a batch, where its rest may be in another, is given whatever its count."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            seqs, times = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            rows, length = _padded(seqs)
            needed = np.array(least)[rows[:, 0]]
            active, new = np.arange(len(seqs)), np.append(True, (rows[1:, :_HEAD] != rows[:-1, :_HEAD]).any(axis=1))
            found, counts = [], []
            for depth in range(_HEAD, rows.shape[1]):
                run = np.cumsum(new) - 1
                first = active[new]
                next_counts = np.bincount(run * (CUT + 1) + rows[active, depth], times[active], minlength=len(first) * (CUT + 1)).astype(np.int64).reshape(-1, CUT + 1)
                kept = next_counts.sum(axis=1) >= needed[first]
                kept[run[(active == 0) | (active == len(seqs) - 1)]] = True
                found += [seqs[i][:depth] for i in first[kept]]
                counts.append(next_counts[kept, : END + 1])
                on = kept[run] & (length[active] > depth + 1)
                active, run = active[on], run[on]
                if not len(active):
                    break
                new = np.append(True, (run[1:] != run[:-1]) | (rows[active[1:], depth] != rows[active[:-1], depth]))
            table = np.concatenate(counts)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int32()), pa.array(found, pa.binary()), *(pa.array(table[:, c]) for c in range(END + 1))], names=["kind", "seq", *_COUNTS])

    return count


def _grow(automata: dict[int, tuple[np.ndarray, np.ndarray]]):
    """The automaton of a kind with the counted prefixes hung on its states and merged."""

    def grow(nodes: pd.DataFrame) -> pd.DataFrame:
        kind = int(nodes["kind"].iloc[0])
        counts, targets = automata[kind]
        tree = Automaton(counts.sum(axis=1).tolist(), [{c: int(n) for c, n in enumerate(r) if n} for r in counts], [{c: int(t) for c, t in enumerate(r) if t >= 0} for r in targets])
        number: dict[bytes, int] = {}
        rows = sorted(((bytes(x), [int(n) for n in r]) for x, *r in nodes[["seq", *_COUNTS]].itertuples(index=False)), key=lambda x: (len(x[0]), x[0]))
        for prefix, following in rows:
            following = {c: n for c, n in enumerate(following) if n}
            if len(prefix) == _HEAD:  # the root, before anything was counted
                tree.counts[0], tree.arrivals[0] = following, sum(following.values())
            else:
                parent = prefix[:-1]
                number[prefix] = tree.targets[number[parent] if len(parent) > _HEAD else int.from_bytes(parent[1:], "big")][prefix[-1]] = len(tree.arrivals)
                tree.arrivals.append(sum(following.values()))
                tree.counts.append(following)
                tree.targets.append({})
        counts, targets = tree.arrays(tree.merge(settled=len(counts)))
        state, symbol = np.indices(counts.shape)
        return pd.DataFrame({"kind": kind, "state": state.ravel(), "symbol": symbol.ravel(), "target": targets.ravel(), "n": counts.ravel()})

    return grow


def _run(automata: dict[int, tuple[np.ndarray, np.ndarray]]):
    """Counts of every state's next classes and ends, all examples run through whole."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {kind: np.zeros(len(counts) * (END + 1), dtype=np.int64) for kind, (counts, _) in automata.items()}
        for batch in batches:
            kinds, values = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for kind, (counts, targets) in automata.items():
                targets = _tables(counts, targets)[1]
                mine = [values[i] for i in np.flatnonzero(kinds == kind)]
                for at, c in _steps(mine, targets):
                    seen[kind] += np.bincount(at * (END + 1) + c, minlength=len(seen[kind]))
        for kind, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, dtype=np.int32)), pa.array((at // (END + 1)).astype(np.int32)), pa.array((at % (END + 1)).astype(np.int32)), pa.array(n[at])], names=["kind", "state", "symbol", "n"])

    return run


def _arrays(rows: pd.DataFrame, states: int) -> np.ndarray:
    out = np.zeros((states, END + 1), dtype=np.int64)
    out[rows["state"], rows["symbol"]] = rows["n"]
    return out


def automata_of(examples: DataFrame, sizes: dict[int, int]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Tables of the automata of all kinds (``sizes``: their numbers of examples) from all rows of ``examples`` (kind, value), which are different."""
    least = [max(1, math.ceil(sizes.get(kind, 0) / PATHS)) for kind in range(len(NAMES))]
    empty = (np.zeros((1, END + 1), dtype=np.int64), np.full((1, END + 1), -1))
    automata = dict.fromkeys(sorted(sizes), empty)
    growing, shortest = set(sizes), _HEAD
    while growing:
        part = {kind: automata[kind] for kind in growing}
        left = examples.where(F.col("kind").isin(sorted(growing))).mapInArrow(_frontier(part), "seq binary").groupBy("seq").count()
        ordered = left.repartitionByRange("seq").sortWithinPartitions("seq")
        nodes = ordered.mapInArrow(_prefixes(least), "kind int, seq binary, " + ", ".join(f"{c} long" for c in _COUNTS))
        nodes = nodes.groupBy("kind", "seq").agg(*(F.sum(c).alias(c) for c in _COUNTS)).where(sum(F.col(c) for c in _COUNTS) >= F.array(*map(F.lit, least))[F.col("kind")]).where(F.length("seq") >= shortest)
        rows = nodes.groupBy("kind").applyInPandas(_grow(part), "kind int, state int, symbol int, target int, n long").toPandas()  # a few hundred states
        growing, shortest = set(), _HEAD + 1  # every further round gives some state a way that it lacked, and goes beyond it
        for kind, grown in rows.groupby("kind"):
            states = int(grown["state"].max()) + 1
            targets = np.full((states, END + 1), -1)
            targets[grown["state"], grown["symbol"]] = grown["target"]
            automata[int(kind)] = _arrays(grown, states), targets
            if least[int(kind)] > 1:  # else nothing is left to be counted
                growing.add(int(kind))
    seen = examples.mapInArrow(_run(automata), "kind int, state int, symbol int, n long").groupBy("kind", "state", "symbol").agg(F.sum("n").alias("n")).toPandas()
    return {NAMES[kind]: _tables(_arrays(seen[seen["kind"] == kind], len(targets)), targets) for kind, (_, targets) in automata.items()}


def _steps(values: list[bytes], targets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """States and classes (or ends) of these values, all of them advancing together."""
    length = np.array([len(v) for v in values], dtype=np.int64)
    order = np.argsort(-length, kind="stable")
    classes = _CLASS_OF[np.frombuffer(b"".join(values), np.uint8)]
    at = (np.cumsum(length) - length)[order]
    state = np.zeros(len(values), dtype=np.int64)
    for i, n in enumerate(np.searchsorted(-length[order], -np.arange(length.max(initial=0)))):  # values longer than i
        c = classes[at[:n] + i]
        yield state[:n].copy(), c
        state[:n] = targets[state[:n], c]
    yield state, np.full(len(values), END)


def log_likelihoods(values: list[bytes], logs: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Log-likelihood of every value, all values advancing together."""
    length = np.array([len(v) for v in values], dtype=np.int64)
    order = np.argsort(-length, kind="stable")
    classes = _CLASS_OF[np.frombuffer(b"".join(values), np.uint8)]
    at = (np.cumsum(length) - length)[order]
    active = np.searchsorted(-length[order], -np.arange(length.max(initial=0)))  # values longer than i
    state, total = np.zeros(len(values), dtype=np.int64), np.zeros(len(values))
    for i, n in enumerate(active):
        c = classes[at[:n] + i]
        total[:n] += logs[state[:n], c]
        state[:n] = targets[state[:n], c]
    total += logs[state, END]
    out = np.empty(len(values))
    out[order] = total
    return out


@dataclass
class Grammars:
    """Automata by kind, and the least mean log-odds of each."""

    tables: dict[str, tuple[np.ndarray, np.ndarray]]
    least: dict[str, float]

    def odds(self, values: list[bytes], kind: str) -> np.ndarray:
        """Log-odds against the background, in all."""
        against = self.tables.get(BACKGROUND, (np.full((1, END + 1), -math.log(END + 1)), np.zeros((1, END + 1), np.int64)))
        return log_likelihoods(values, *self.tables[kind]) - log_likelihoods(values, *against)

    def score(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Largest mean log-odds over the kinds, and whether a kind takes the value for one of its own."""
        best, taken = np.full(len(values), -np.inf), np.zeros(len(values), dtype=bool)
        if values:
            places = np.array([len(v) + 1 for v in values])
            for kind in self.least:
                odds = self.odds(values, kind)
                best = np.maximum(best, odds / places)
                taken |= (odds / places >= self.least[kind]) & (odds >= LEAST_ODDS)
        return best, taken


def _odds_keys(grammars: Grammars):
    """Kind and mean log-odds of every example, as whole numbers of the same order."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for kind in np.unique(kinds):
                mine = [values[i] for i in np.flatnonzero(kinds == kind)]
                mean = grammars.odds(mine, NAMES[kind]) / np.array([len(v) + 1 for v in mine]) + 0.0
                bits = mean.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(mine), kind, dtype=np.int32)), pa.array(bits ^ ((bits >> 63) & np.int64(2**63 - 1)))], names=["kind", "key"])

    return score


def _ranked(keys: DataFrame, ranks: dict[int, int]) -> dict[int, float]:
    """Per kind the number of this rank (from 0), found 16 bits at a time from the counts of equal beginnings."""
    ranks, begins = dict(ranks), dict.fromkeys(ranks, None)
    for shift in (48, 32, 16, 0):
        mine = [(F.col("kind") == kind) & (F.lit(True) if begin is None else F.shiftright("key", shift + 16) == begin) for kind, begin in begins.items()]
        counted = keys.where(functools.reduce(lambda a, b: a | b, mine)).groupBy("kind", F.shiftright("key", shift).alias("begin")).count()
        for kind, part in counted.toPandas().groupby("kind"):  # 65,536 rows of a kind at most
            part = part.sort_values("begin")
            before = part["count"].cumsum() - part["count"]
            i = int((before <= ranks[kind]).sum()) - 1
            begins[kind], ranks[kind] = int(part["begin"].iloc[i]), ranks[kind] - int(before.iloc[i])
    keys_found = np.array(list(begins.values()), dtype=np.int64)
    return dict(zip(begins, (keys_found ^ ((keys_found >> 63) & np.int64(2**63 - 1))).view(np.float64).tolist(), strict=True))


def fit(found: DataFrame) -> Grammars:
    """Automata of the kinds that ``found`` has examples of. Three of four values are learned from, the fourth calibrates."""
    labelled = found.select(F.explode(F.arrays_zip("kinds", "vals")).alias("x")).select(F.col("x.kinds").alias("kind"), F.col("x.vals").alias("value"))
    others = found.select(F.lit(len(KINDS)).alias("kind"), F.explode("cands").alias("value"))
    examples = materialize(labelled.unionByName(others).distinct().withColumn("aside", F.pmod(F.xxhash64("value"), F.lit(4)) == 0), "secret-examples")
    counted = {(r.kind, r.aside): r["count"] for r in examples.groupBy("kind", "aside").count().collect()}
    grammars = Grammars(automata_of(examples.where("not aside").select("kind", "value"), {kind: n for (kind, aside), n in counted.items() if not aside}), {})
    ranks, held = {}, F.lit(False)
    for kind, name in enumerate(KINDS):
        learned, aside = counted.get((kind, False), 0), counted.get((kind, True), 0)
        if learned and learned + aside >= LEAST_EXAMPLES:
            ranks[kind] = (aside or learned) // 50
            held |= (F.col("kind") == kind) & (F.col("aside") if aside else F.lit(True))
    if ranks:
        keys = materialize(examples.where(held).select("kind", "value").mapInArrow(_odds_keys(grammars), "kind int, key long"), "secret-odds")
        grammars.least = {KINDS[kind]: least for kind, least in sorted(_ranked(keys, ranks).items())}
    return grammars


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex (base spans), base_sha256, spans (base ones and those of a credential's format), n_format, format_score (largest mean
    log-odds of a candidate; null without one or without examples).

    Spans are kind:start:end, end exclusive, by start and kind, joined by commas. Nulls, repeated rows, very long texts (read whole) and extra columns: as the
    module says; equal rows get equal results.
    """
    found = materialize(finds(docs), "secret-finds")
    grammars = fit(found)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            best, taken = grammars.score([c for r in rows for c in r["cands"]])
            out: list[tuple] = []
            at = 0
            for r in rows:
                base = list(zip(r["starts"], r["kinds"], r["ends"], strict=True))
                named = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base)
                n = len(r["cands"])
                more = [(s, len(KINDS), s + len(c)) for s, c, t in zip(r["cand_starts"], r["cands"], taken[at : at + n], strict=True) if t]
                top = best[at : at + n].max(initial=-np.inf)
                at += n
                spans = ",".join(f"{(*KINDS, FOUND)[k]}:{s}:{e}" for s, k, e in sorted(base + more))
                out.append((r["doc_id"], *(r["kinds"].count(k) for k in range(len(KINDS))), hashlib.sha256(named.encode()).hexdigest(), spans, len(more), float(top) if np.isfinite(top) else None))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], t) for t in types], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format", "format_score"])

    return found.select("doc_id", "kinds", "starts", "ends", "cand_starts", "cands").mapInArrow(score, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long, format_score double")
