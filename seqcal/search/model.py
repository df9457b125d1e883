"""Profile models: the ASCII format of HMMER3 files and the local multihit configuration (Eddy 2008, 2011)."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from ..operators.checks import InputError

RESIDUES = "ACDEFGHIKLMNPQRSTVWY"
# Background frequencies of the 20 residues, in the order of RESIDUES.
BACKGROUND = np.array([
    0.0787945, 0.0151600, 0.0535222, 0.0668298, 0.0397062, 0.0695071, 0.0229198, 0.0590092, 0.0594422, 0.0963728,
    0.0237718, 0.0414386, 0.0482904, 0.0395639, 0.0540978, 0.0683364, 0.0540687, 0.0673417, 0.0114135, 0.0304133,
])
# What degenerate letters stand for.
DEGENERATE = {"B": "DN", "J": "IL", "O": "K", "U": "C", "X": RESIDUES, "Z": "EQ"}
MM, MI, MD, IM, II, DM, DD = range(7)
FIELDS_HELD = 1 << 16  # numbers of model files, of five decimals, that repeat


@dataclass(frozen=True)
class Profile:
    """match (M, 20) and moves (M + 1, 7) are probabilities; mu and decay describe the Forward score's tail."""

    name: str
    match: np.ndarray
    moves: np.ndarray
    mu: float
    decay: float

    @property
    def match_states(self) -> int:
        return len(self.match)

    def letter_scores(self) -> np.ndarray:
        """(26, M) log-odds of every letter A-Z against the background."""
        with np.errstate(divide="ignore"):
            odds = np.log(self.match / BACKGROUND)
        out = np.zeros((26, self.match_states))
        for i, letter in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZ"):
            at = [RESIDUES.index(r) for r in DEGENERATE.get(letter, letter)]
            weights = BACKGROUND[at] / BACKGROUND[at].sum()
            with np.errstate(invalid="ignore"):
                out[i] = odds[:, at[0]] if len(at) == 1 else (np.where(np.isfinite(odds[:, at]), odds[:, at], -30.0) * weights).sum(axis=1)
        return out

    def entry(self) -> np.ndarray:
        """Log-probabilities of entering at each match state: uniform over the fragments that reach it."""
        m, t = self.match_states, self.moves
        occupancy = np.zeros(m)
        occupancy[0] = t[0, MM] + t[0, MI]
        for k in range(1, m):
            occupancy[k] = occupancy[k - 1] * (t[k, MM] + t[k, MI]) + (1 - occupancy[k - 1]) * t[k, DM]
        with np.errstate(divide="ignore"):
            return np.log(occupancy / (occupancy * np.arange(m, 0, -1)).sum())


def clean_name(name: str) -> str:
    name = name.strip().removesuffix(".hmm")
    if not name:
        raise InputError("profile name is empty")
    return name


@lru_cache(FIELDS_HELD)
def _probability(field: str) -> float:
    return 0.0 if field == "*" else math.exp(-float(field))


@lru_cache(FIELDS_HELD)
def _field(value: float) -> str:
    return "*" if value == 0 else f"{-math.log(value):.5f}"


def load_hmms(path: str, selected: Iterable[str] | None = None) -> list[Profile]:
    """parse_profiles of a file."""
    try:
        with open(path, encoding="utf-8") as text:
            return parse_profiles(text.read(), selected)
    except IsADirectoryError as error:
        raise InputError(f"profile file is a folder: {path}") from error


def parse_profiles(text: str, selected: Iterable[str] | None = None) -> list[Profile]:
    """The profiles of an ASCII model file in file order; selected names pick some of them."""
    wanted = None
    if selected is not None:
        names = [clean_name(n) for n in selected]
        if not names or len(set(names)) < len(names):
            raise InputError("requested profiles must be present and unique")
        wanted = set(names)
    found: list[Profile] = []
    seen: set[str] = set()
    for block in text.split("\n//"):
        lines = [x for x in block.split("\n") if x.strip()]
        if not lines:
            continue
        if not lines[0].startswith("HMMER3/"):
            raise InputError("not an ASCII model file")
        tags: dict[str, str] = {}
        mu, decay, at = -5.0, math.log(2), 0
        for at, line in enumerate(lines):
            if line.startswith("HMM "):
                break
            key, _, value = line.strip().partition(" ")
            tags[key] = value.strip()
            if key == "STATS" and value.split()[:2] == ["LOCAL", "FORWARD"]:
                mu, decay = map(float, value.split()[2:4])
        name = clean_name(tags.get("NAME", ""))
        if name in seen:
            raise InputError(f"duplicate profile: {name}")
        seen.add(name)
        if wanted is not None and name not in wanted:
            continue
        order = lines[at].split()[1:]
        rows = [x.split() for x in lines[at + 2 :]]
        if rows[0][0] == "COMPO":
            rows = rows[1:]
        m = int(tags["LENG"])
        try:
            moves = [[_probability(x) for x in rows[1][:7]]]
            match = []
            for k in range(m):
                line, _, move = rows[2 + 3 * k : 5 + 3 * k]
                values = dict(zip(order, (_probability(x) for x in line[1:21]), strict=True))
                match.append([values[r] for r in RESIDUES])
                moves.append([_probability(x) for x in move[:7]])
        except (IndexError, ValueError, KeyError) as error:
            raise InputError(f"broken profile: {name}") from error
        found.append(Profile(name, np.array(match), np.array(moves), mu, decay))
    missing = sorted((wanted or set()) - seen)
    if missing:
        raise InputError(f"profiles not found: {', '.join(missing)}")
    if not found:
        raise InputError("no profiles")
    return found


def consensus_profile(name: str, letters: str, conserved: float = 0.9, gap: float = 0.01, mu: float = -4.0, decay: float = math.log(2)) -> Profile:
    """A profile around one sequence: each position keeps its letter with probability conserved."""
    match = np.tile(BACKGROUND / BACKGROUND.sum() * (1 - conserved), (len(letters), 1))
    for k, letter in enumerate(letters):
        own = DEGENERATE.get(letter, letter)
        match[k, [RESIDUES.index(r) for r in own]] += conserved / len(own)
    moves = np.tile(np.array([1 - 2 * gap, gap, gap, 0.5, 0.5, 0.5, 0.5]), (len(letters) + 1, 1))
    moves[-1] = [1 - gap, gap, 0, 0.5, 0.5, 1, 0]
    return Profile(name, match, moves, mu, decay)


def format_profile(p: Profile) -> str:
    """p in the ASCII format."""
    say = lambda values: " ".join(map(_field, values.tolist()))
    lines = ["HMMER3/f [seqcal]", f"NAME  {p.name}", f"LENG  {p.match_states}", "ALPH  amino", f"STATS LOCAL FORWARD {p.mu} {p.decay}", "HMM " + " ".join(RESIDUES), "m->m m->i m->d i->m i->i d->m d->d"]
    inserts = say(BACKGROUND)
    lines += [inserts, say(p.moves[0])]
    for k in range(p.match_states):
        lines += [f"{k + 1} {say(p.match[k])} {k + 1} - - - -", inserts, say(p.moves[k + 1])]
    return "\n".join(lines) + "\n//\n"
