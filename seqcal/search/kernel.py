"""Profile search in partitions: Forward scores for all pairs of a profile and a sequence, Viterbi paths for domains.

Many sequences and profiles go through each numpy step together. Backend "numpy-viterbi-v1": domains are Viterbi segments rescored by Forward, without composition corrections, so
scores are close to, but not those of, HMMER. The search space Z is given, so results don't depend on partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..operators import checks, hits
from ..shared import spread
from ..shipping import ship
from .model import DD, DM, II, IM, MD, MI, MM, Profile

BACKEND = "numpy-viterbi-v1"
LOW, BIG = -1e30, 1e100
STACK_STATES, STACK_CELLS = 4096, 1 << 16  # states of a stack; cells (states by sequences) of a step of its Forward sums
PAIR_CELLS, PAIR_PLACES, BATCH_LETTERS = 1 << 15, 1 << 22, 1 << 22


class SearchBackend(Protocol):
    """Anything that turns records(target_id, sequence) into raw domain rows."""

    def search(self, records: DataFrame, options: dict[str, float]) -> DataFrame: ...


class Compiled:
    """A profile as log-probabilities, with the states M_1..M_m in columns 0..m-1."""

    def __init__(self, profile: Profile):
        with np.errstate(divide="ignore"):
            t = np.maximum(np.log(profile.moves), LOW)
        self.profile, self.letters, self.enter = profile, np.maximum(profile.letter_scores(), LOW), np.maximum(profile.entry(), LOW)
        inner = t[1:]
        self.mm, self.im, self.dm = inner[:-1, MM], inner[:-1, IM], inner[:-1, DM]  # from k to k + 1
        self.mi, self.ii = inner[:, MI].copy(), inner[:, II].copy()
        self.mi[-1] = LOW  # the last state has no insert
        self.md = inner[:-1, MD]
        # sums of delete steps, so that a run of deletes is one scan
        self.dd = np.concatenate([[0.0], np.cumsum(np.maximum(inner[:-1, DD], -700.0))])


def _shift(x: np.ndarray, moves: np.ndarray) -> np.ndarray:
    return np.concatenate([np.full((*x.shape[:-1], 1), LOW), x[..., :-1] + moves], axis=-1)


def _deletes(match: np.ndarray, md: np.ndarray, dd: np.ndarray) -> np.ndarray:
    """D_k = log-sum over j < k of M_j + md_j + dd between j + 1 and k."""
    return np.maximum(np.logaddexp.accumulate(_shift(match, md) - dd, axis=-1) + dd, LOW)


def length_model(n: np.ndarray | float) -> tuple:
    """Log-probabilities of staying in and leaving the flanking states, and of the null model."""
    return np.log(n / (n + 3)), np.log(3 / (n + 3)), n * np.log(n / (n + 1)) - np.log(n + 1)


class Stack:
    """Profiles side by side as probabilities, the longest first: level k is state k of all profiles that reach it, so a
    step from state to state is one slice for all of them."""

    def __init__(self, compiled: list[Compiled]):
        self.compiled = sorted(compiled, key=lambda c: -c.profile.match_states)
        lengths = np.array([c.profile.match_states for c in self.compiled])
        self.width = [int((lengths > k).sum()) for k in range(lengths[0])]
        self.first = np.cumsum([0, *self.width[:-1]]).tolist()
        self.states = int(lengths.sum())
        level = lambda values: np.exp(np.array([values(c)[k] for k, w in enumerate(self.width) for c in self.compiled[:w]]))[:, None]
        last = lambda values: np.append(values, -np.inf)  # no move leads on from the last state
        self.enter, self.mi, self.ii = level(lambda c: c.enter), level(lambda c: c.mi), level(lambda c: c.ii)
        self.mm, self.im, self.dm, self.md = (level(lambda c, n=n: last(getattr(c, n))) for n in ("mm", "im", "dm", "md"))
        self.dd = level(lambda c: last(np.diff(c.dd)))
        self.letters = np.concatenate([np.exp([c.letters[:, k] for c in self.compiled[:w]]) for k, w in enumerate(self.width)])


def stacks(compiled: list[Compiled]) -> list[Stack]:
    """All profiles, in stacks of STACK_STATES states or of one profile."""
    out, states = [[]], 0
    for c in sorted(compiled, key=lambda c: -c.profile.match_states):
        if out[-1] and states + c.profile.match_states > STACK_STATES:
            out, states = [*out, []], 0
        out[-1].append(c)
        states += c.profile.match_states
    return [Stack(x) for x in out if x]


def _padded(sequences: list[np.ndarray]) -> np.ndarray:
    """(place, sequence), the longest first."""
    out = np.zeros((len(sequences[0]), len(sequences)), dtype=np.int64)
    for i, s in enumerate(sequences):
        out[: len(s), i] = s
    return out


def stack_bits(stack: Stack, sequences: list[np.ndarray]) -> np.ndarray:
    """Forward scores in bits, (profile, sequence), of sequences, longest first.

    Sums are of probabilities, not of logarithms. Where a pair's own sum passes BIG, all its numbers are divided by it
    and its logarithm is kept; a number that is too small to be told from zero then is too small to count.
    """
    lengths = np.array([len(s) for s in sequences])
    n, places, p = len(sequences), _padded(sequences), len(stack.compiled)
    stay, leave, null = length_model(lengths.astype(float))
    stays, leaves = np.exp(stay), np.exp(leave)
    flank, join, close, scale = np.ones((p, n)), np.zeros((p, n)), np.zeros((p, n)), np.zeros((p, n))
    match, insert, delete = (np.zeros((stack.states, n)) for _ in range(3))
    onward, spare = np.empty((stack.states, n)), np.empty((stack.states, n))
    levels = [(a, a + w, w, b) for a, w, b in zip(stack.first, stack.width, [0, *stack.first])]
    live = n
    for i in range(lengths[0]):
        while lengths[live - 1] <= i:
            live -= 1
        m, ins, d, on, tmp = (x[:, :live] for x in (match, insert, delete, onward, spare))
        f, j, c = (x[:, :live] for x in (flank, join, close))
        begin = (f + j) * leaves[:live]
        np.multiply(m, stack.mm, out=on)
        on += np.multiply(ins, stack.im, out=tmp)
        on += np.multiply(d, stack.dm, out=tmp)
        ins *= stack.ii
        ins += np.multiply(m, stack.mi, out=tmp)
        for a, b, w, before in levels:
            np.multiply(begin[:w], stack.enter[a:b], out=m[a:b])
            if a:
                m[a:b] += on[before : before + w]
        m *= np.take(stack.letters, places[i, :live], axis=1)
        np.multiply(m, stack.md, out=on)
        end = np.zeros_like(begin)
        for a, b, w, before in levels:
            if a:
                np.multiply(d[before : before + w], stack.dd[before : before + w], out=d[a:b])
                d[a:b] += on[before : before + w]
                end[:w] += d[a:b]
            end[:w] += m[a:b]
        end *= 0.5
        f *= stays[:live]
        for x in (j, c):
            x *= stays[:live]
            x += end
        if (c > BIG).any():
            by = np.where(c > BIG, c, 1.0)
            scale[:, :live] += np.log(by)
            for x in (f, j, c):
                x /= by
            for x in (m, ins, d):
                for a, b, w, _ in levels:
                    x[a:b] /= by[:w]
    with np.errstate(divide="ignore"):
        return (np.maximum(np.log(close), LOW) + scale + leave - null) / np.log(2)


def forward_bits(c: Compiled, sequences: list[np.ndarray]) -> np.ndarray:
    """Forward scores in bits of sequences, longest first."""
    return stack_bits(Stack([c]), sequences)[0]


class Pairs:
    """Pairs of a profile and a sequence side by side, (state, pair); states that a profile lacks can't be entered."""

    def __init__(self, compiled: list[Compiled]):
        own = list({id(c): c for c in compiled}.values())
        number = {id(c): i for i, c in enumerate(own)}
        self.profile = np.array([number[id(c)] for c in compiled])
        self.states = max(c.profile.match_states for c in own)
        fill = lambda values, none: np.stack([np.append(x, np.full(self.states - len(x), none)) for x in map(values, own)], axis=1)
        for name in ("enter", "mi", "ii", "mm", "im", "dm", "md"):
            setattr(self, name, fill(lambda c, name=name: getattr(c, name), LOW)[:, self.profile])
        self.dd = fill(lambda c: c.dd, 0.0)[:, self.profile]
        self.absent = fill(lambda c: np.zeros(c.profile.match_states), LOW)[:, self.profile]
        self.letters = np.stack([np.pad(c.letters, ((0, 0), (0, self.states - c.profile.match_states)), constant_values=LOW) for c in own]).reshape(-1, self.states)

    def letter_scores(self, letters: np.ndarray) -> np.ndarray:
        """(pair, state) of a letter for each of the first pairs."""
        return self.letters[self.profile[: len(letters)] * 26 + letters]


def pair_domains(compiled: list[Compiled], sequences: list[np.ndarray]) -> list[list[tuple[int, int, int, int]]]:
    """(first position, last position, first state, last state), 0-based, of each pass of a pair's best path through its
    profile; the pairs with the longest sequences first."""
    pairs, places = Pairs(compiled), _padded(sequences)
    lengths = np.array([len(s) for s in sequences])
    n, m, total = len(sequences), pairs.states, int(lengths[0])
    stay, leave, _ = length_model(lengths.astype(float))
    half = np.log(0.5)
    match, insert, delete = (np.full((m, n), LOW) for _ in range(3))
    # where a state's best path entered, as position * m + state, carried along with the scores
    at_match, at_insert, at_delete = (np.full((m, n), -1, dtype=np.int64) for _ in range(3))
    flank, join, close = np.zeros(n), np.full(n, LOW), np.full(n, LOW)
    # a pass is named by its last position; -1 is none
    join_from, close_from = np.full(n, -1, dtype=np.int32), np.full(n, -1, dtype=np.int32)
    begun, behind, last = (np.full((total, n), -1, dtype=np.int32) for _ in range(3))  # the pass before each entry, that before each pass, its last state
    entered = np.full((total, n), -1, dtype=np.int64)
    states = np.arange(m)[:, None]
    live = n
    for i in range(total):
        while lengths[live - 1] <= i:
            live -= 1
        a = slice(0, live)
        begin = np.where(flank[a] >= join[a], flank[a], join[a])
        begun[i, a] = np.where(flank[a] >= join[a], -1, join_from[a])
        begin += leave[a]
        best, came = np.full((m, live), LOW), np.full((m, live), -1, dtype=np.int64)
        np.add(match[:-1, a], pairs.mm[:-1, a], out=best[1:])
        came[1:] = at_match[:-1, a]
        for score, at, move in ((insert, at_insert, pairs.im), (delete, at_delete, pairs.dm)):
            other = score[:-1, a] + move[:-1, a]
            np.copyto(came[1:], at[:-1, a], where=other > best[1:])
            np.maximum(best[1:], other, out=best[1:])
        other = begin + pairs.enter[:, a]
        np.copyto(came, i * m + states, where=other > best)
        np.maximum(best, other, out=best)
        stays, opens = insert[:, a] + pairs.ii[:, a], match[:, a] + pairs.mi[:, a]
        at_insert[:, a] = np.where(stays > opens, at_insert[:, a], at_match[:, a])
        np.maximum(stays, opens, out=insert[:, a])
        np.add(best, pairs.letter_scores(places[i, a]).T, out=match[:, a])
        at_match[:, a] = came
        opened = np.full((m, live), LOW)
        np.add(match[:-1, a], pairs.md[:-1, a], out=opened[1:])
        opened -= pairs.dd[:, a]
        run = np.maximum.accumulate(opened, axis=0)
        at_delete[0, a] = came[0]
        at_delete[1:, a] = came[:-1]
        for k in range(1, m):
            np.copyto(at_delete[k, a], at_delete[k - 1, a], where=opened[k] != run[k])
        np.maximum(run + pairs.dd[:, a], LOW, out=delete[:, a])
        k = match[:, a].argmax(axis=0)
        end = np.take_along_axis(match[:, a], k[None], axis=0)[0] + half
        flank[a] += stay[a]
        join[a] += stay[a]
        close[a] += stay[a]
        some = np.flatnonzero((end > join[a]) | (end > close[a]))
        if len(some):
            entered[i, some], last[i, some] = came[k[some], some], k[some]
            behind[i, some] = begun[entered[i, some] // m, some]
            for score, source in ((join, join_from), (close, close_from)):
                up = some[end[some] > score[some]]
                score[up], source[up] = end[up], i
    out = []
    for p, at in enumerate(close_from.tolist()):
        found = []
        while at >= 0:
            first, low = divmod(int(entered[at, p]), m)
            found.append((first, at, low, int(last[at, p])))
            at = int(behind[at, p])
        out.append(found[::-1])
    return out


def viterbi_domains(c: Compiled, sequence: np.ndarray) -> list[tuple[int, int, int, int]]:
    return pair_domains([c], [sequence])[0]


def segments_bits(compiled: list[Compiled], segments: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
    """Forward scores of one pass over each segment, the rest of its sequence of so many letters in the flanking states;
    the longest segments first."""
    pairs, places, n = Pairs(compiled), _padded(segments), len(segments)
    enter, mi, ii, mm, im, dm, md, dd, absent = (np.ascontiguousarray(x.T) for x in (pairs.enter, pairs.mi, pairs.ii, pairs.mm[:-1], pairs.im[:-1], pairs.dm[:-1], pairs.md[:-1], pairs.dd, pairs.absent))
    own = np.array([len(s) for s in segments])
    stay, leave, null = length_model(lengths.astype(float))
    match, insert, delete = (np.full((n, pairs.states), LOW) for _ in range(3))
    live = n
    for i in range(own[0]):
        while own[live - 1] <= i:
            live -= 1
        a = slice(0, live)
        begin = (LOW if i else 0.0) + enter[a]
        fresh = np.logaddexp(np.logaddexp(_shift(match[a], mm[a]), _shift(insert[a], im[a])), np.logaddexp(_shift(delete[a], dm[a]), begin))
        insert[a] = np.logaddexp(match[a] + mi[a], insert[a] + ii[a])
        match[a] = fresh + pairs.letter_scores(places[i, a])
        delete[a] = np.maximum(_deletes(match[a], md[a], dd[a]) + absent[a], LOW)
    end = np.logaddexp(np.logaddexp.reduce(match, axis=1), np.logaddexp.reduce(delete, axis=1))
    outside = (lengths - own) * stay + 2 * leave + np.log(0.5)
    return (end + outside - null) / np.log(2)


def segment_bits(c: Compiled, sequence: np.ndarray, first: int, last: int) -> float:
    return float(segments_bits([c], [sequence[first : last + 1]], np.array([len(sequence)]))[0])


def _groups(states: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Which pairs are run together: of profiles and sequences alike in size, the longest sequences first, in bounded memory."""
    size = np.ceil(np.log2(states)).astype(np.int64)
    order = np.lexsort((-lengths, size))
    at = 0
    while at < len(order):
        most = min(PAIR_CELLS >> int(size[order[at]]), PAIR_PLACES // max(1, int(lengths[order[at]])))
        to = min(at + max(1, most), int(np.searchsorted(size[order], size[order[at]], side="right")))
        yield order[at:to]
        at = to


def tail(bits: float | np.ndarray, p: Profile) -> np.ndarray:
    return np.minimum(1.0, np.exp(-p.decay * (np.asarray(bits) - p.mu)))


def search_batch(ids: list[str], texts: list[str], stack: Stack, options: dict[str, float]) -> list[tuple]:
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    coded = [np.frombuffer(texts[i].encode("ascii"), np.uint8).astype(np.int64) - 65 for i in order]
    own, of, n = stack.compiled, [c.profile for c in stack.compiled], max(1, STACK_CELLS // stack.states)
    # sequences of similar length together, so that few steps are taken for few of them
    bits = np.concatenate([stack_bits(stack, coded[at : at + n]) for at in range(0, len(coded), n)], axis=1)
    evalues = np.stack([options["Z"] * tail(b, p) for b, p in zip(bits, of, strict=True)])
    pair, target = np.nonzero(evalues <= options.get("E", 10.0))
    states, lengths = np.array([p.match_states for p in of]), np.array([len(s) for s in coded])
    found = []  # profile, target and domain
    for some in _groups(states[pair], lengths[target]):
        passes = pair_domains([own[p] for p in pair[some]], [coded[t] for t in target[some]])
        found += [(p, t, *d) for p, t, domains in zip(pair[some].tolist(), target[some].tolist(), passes, strict=True) for d in domains if (d[3] - d[2] + 1) / of[p].match_states >= options["coverage"]]
    rows = []
    table = np.array(found, dtype=np.int64).reshape(-1, 6)
    for some in _groups(states[table[:, 0]], table[:, 3] - table[:, 2] + 1):
        part = table[some]
        scores = segments_bits([own[p] for p in part[:, 0]], [coded[t][first : last + 1] for _, t, first, last, _, _ in part.tolist()], lengths[part[:, 1]])
        for (p, t, first, last, low, high), score in zip(part.tolist(), scores.tolist(), strict=True):
            value, n = options["Z"] * float(tail(score, of[p])), len(coded[t])
            if value <= options["iE"]:
                rows.append((of[p].name, ids[order[t]], float(evalues[p, t]), n, value, score, low + 1, high + 1, of[p].match_states, first + 1, last + 1, n))
    return rows


RAW_COLUMNS = [x.split()[0] for x in hits.RAW_DOMAIN.split(",")]


def search_frame(records: DataFrame, profiles: list[Profile], options: dict[str, float]) -> DataFrame:
    """Raw domain rows of records(target_id, sequence). Both limits are pushed into the kernel; profiles travel once to
    each executor, a library of models being a stated parameter of the search."""
    ship(records.sparkSession)
    shared = records.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        library = stacks([Compiled(p) for p in shared.value])
        for batch in batches:
            # of similar length together, and no more letters at a time than BATCH_LETTERS
            batch = batch.sort_values("sequence", key=lambda s: s.str.len(), ascending=False)
            letters = batch["sequence"].str.len().cumsum() // BATCH_LETTERS
            for _, part in batch.groupby(letters, sort=False):
                for stack in library:
                    yield pd.DataFrame(search_batch(part["target_id"].tolist(), part["sequence"].tolist(), stack, options), columns=RAW_COLUMNS)

    clean = records.select(T.trim_space(F.col("target_id")).alias("target_id"), T.normalised_sequence(F.col("sequence")).alias("sequence")).filter("sequence <> ''")
    return spread(clean).mapInPandas(run, hits.RAW_DOMAIN)


class NumpyBackend:
    def __init__(self, profiles: list[Profile]):
        self.profiles = profiles

    def search(self, records: DataFrame, options: dict[str, float]) -> DataFrame:
        return search_frame(records, self.profiles, options)


class PrecomputedDomains:
    """Raw rows that another program has made."""

    def __init__(self, raw: DataFrame):
        self.raw = raw

    def search(self, records: DataFrame, options: dict[str, float]) -> DataFrame:
        return self.raw.join(records.select("target_id"), "target_id", "left_semi")


def scan_records(records: DataFrame, backend: SearchBackend, **parameters: float) -> DataFrame:
    """Accepted domain hits of records(ordinal, target_id, sequence), after all checks; see checks.search_options."""
    options = checks.search_options(**parameters)
    checks.require(records, checks.record_problem())
    checks.require_unique(records.select(T.trim_space(F.col("target_id")).alias("target_id")), "target_id", "identifier")
    if records.isEmpty():
        raise checks.InputError("no protein records")
    raw = backend.search(records, options).withColumn("ordinal", F.monotonically_increasing_id())
    return hits.checked_domain_hits(raw, options["iE"], options["coverage"]).select(*hits.DOMAIN_HIT)
