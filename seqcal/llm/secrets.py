"""Secret scans with DataFrame functions only: patterns, then sliding-window entropy over candidate strings.

Places come from the pieces between matches: the lengths of split() and of the matches add up to code-point offsets, so
no Python runs. Only texts in which a pattern occurs pay for that. A candidate is a long run of token characters; by the
characters that it holds it belongs to a class with its own threshold. A window of 20 characters slides over it with the
counts of all its characters, of which a step changes two, those of the character that leaves and the one that enters;
H = log2(w) - S / w with S = sum c log2 c, kept as whole millionths, so the sums are exact in any order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CHARS, ACCESS, HEX = 6, "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"  # a failing run holds no passing one
CANDIDATE = "[A-Za-z0-9+/_-]{20,}={0,2}"
WINDOW = 20
#: The characters of candidates but for the padding; their counts are letters of a string in this order, from A for 0.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
#: Classes by the characters of a candidate, in order, and the least entropy of a window: hexadecimal, mixed-case with
#: digits, letters with digits, and letters in which two small ones stand alone between capitals, as words in camel case
#: seldom have them; other candidates are words.
CLASSES = (("^(?=.*[0-9])[0-9a-fA-F]+$", 3.0), ("(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])", 3.8), ("(?=.*[0-9])(?=.*[a-zA-Z])", 3.5), ("[A-Z][a-z][A-Z].*[A-Z][a-z][A-Z]", 3.85))
#: Candidates that are no secrets: placeholders, UUIDs, alphabets, plain numbers.
ALLOWED = (
    "(?i)example|sample|dummy|placeholder|changeme|lorem|xxxx",
    "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "(?i)abcdefghij|0123456789",
    "^[0-9+/_=-]+$",
)

SPANS = "array<struct<start: int, rank: int, stop: int>>"


def _plain(s: str) -> str:
    return "r'" + s.replace("'", r"\x27") + "'"


def match_spans(text: str, pattern: str, rank: int, accept: str | None = None) -> Column:
    """Spans of all matches, leftmost and non-overlapping; accept is SQL over i, the number of a match."""
    step = "named_struct('at', s.at + length(pieces[i]) + length(hits[i]), 'out', if({keep}, array_append(s.out, named_struct('start', s.at + length(pieces[i]), 'rank', {rank}, 'stop', s.at + length(pieces[i]) + length(hits[i]))), s.out))"
    keep = accept or "true"
    lists = f"named_struct('pieces', split({text}, {_plain(pattern)}, -1), 'hits', regexp_extract_all({text}, {_plain(pattern)}, 0)" + (f", 'values', regexp_extract_all({text}, {_plain(pattern)}, 2))" if accept else ")")
    body = step.format(keep=keep, rank=rank)
    for name in ("pieces", "hits", "values"):
        body = body.replace(f"{name}[i]", f"x.{name}[i]")
    walk = f"aggregate(sequence(0, size(x.hits) - 1), named_struct('at', 0, 'out', cast(array() as {SPANS})), (s, i) -> {body}, s -> s.out)"
    # a list of one, so that the pieces are computed once and have a name
    return F.expr(f"case when {text} rlike {_plain(pattern)} then transform(array({lists}), x -> {walk})[0] else cast(array() as {SPANS}) end")


def _terms() -> str:
    return "array(" + ", ".join(f"{round(c * math.log2(c) * 1e6) if c else 0}L" for c in range(WINDOW + 2)) + ")"


def least_sum(codes: str, terms: str) -> str:
    """SQL: the least S over all windows of the array codes, places in ALPHABET (its entropy is the greatest)."""
    count = lambda s, code: f"ascii(substring({s}.counts, {code}, 1)) - 65"
    moved = lambda s, code, n: f"overlay({s}.counts placing char(65 + {n}) from {code} for 1)"
    out, new = f"{codes}[i - {WINDOW + 1}]", f"{codes}[i - 1]"
    leave = f"transform(array({count('s', out)}), n -> named_struct('counts', {moved('s', out, 'n - 1')}, 'now', s.now - {terms}[n] + {terms}[n - 1], 'best', s.best))[0]"
    enter = f"transform(array({count('t', new)}), n -> named_struct('counts', {moved('t', new, 'n + 1')}, 'now', t.now - {terms}[n] + {terms}[n + 1], 'best', t.best))[0]"
    seen = f"transform(array({enter}), u -> named_struct('counts', u.counts, 'now', u.now, 'best', if(i >= {WINDOW}, least(u.best, u.now), u.best)))[0]"
    step = f"transform(array(if(i > {WINDOW}, {leave}, s)), t -> {seen})[0]"
    start = f"named_struct('counts', repeat('A', {len(ALPHABET)}), 'now', 0L, 'best', {2**62}L)"
    return f"aggregate(sequence(1, size({codes})), {start}, (s, i) -> {step}, s -> s.best)"


def entropy_spans(text: str, base: str) -> Column:
    """Spans of candidates with a window above its class's threshold, none that is allowed or lies in a base span."""
    most = "case " + " ".join(f"when x.hit rlike {_plain(p)} then {math.floor((math.log2(WINDOW) - h) * WINDOW * 1e6)}L" for p, h in CLASSES) + " else -1L end"
    allowed = " or ".join(f"x.hit rlike {_plain(p)}" for p in ALLOWED)
    spans = f"arrays_zip(candidates, regexp_extract_all({text}, {_plain(CANDIDATE)}, 0))"
    open_ones = f"filter(transform({spans}, p -> named_struct('span', p.candidates, 'hit', p.`1`, 'terms', {_terms()}, 'codes', transform(split(regexp_replace(p.`1`, '=', ''), ''), c -> locate(c, '{ALPHABET}')))), x -> not ({allowed}) and ({most}) >= 0 and not exists({base}, b -> b.start <= x.span.start and x.span.stop <= b.stop))"
    return F.expr(f"case when size(candidates) = 0 then cast(array() as {SPANS}) else transform(filter({open_ones}, x -> {least_sum('x.codes', 'x.terms')} <= {most}), x -> x.span) end")


def with_secret_spans(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) as doc_id, text, base and spans: arrays of (start, rank, stop), sorted, rank being the
    place in KINDS, offsets in code points, stop exclusive. base holds the pattern matches, spans these and the entropy
    spans, which may overlap base spans that they reach beyond. A null text counts as empty and has none; rows without doc_id and repeated rows are scanned like others.
    """
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = found.withColumn("assign", match_spans("text", ASSIGN, 0, f"length(values[i]) >= {ASSIGN_CHARS}"))
    found = found.withColumn("access", match_spans("text", ACCESS, 1)).withColumn("hexes", match_spans("text", HEX, 2))
    found = found.withColumn("base", F.array_sort(F.concat("assign", "access", "hexes"))).withColumn("candidates", match_spans("text", CANDIDATE, 3))
    return found.withColumn("entropy", entropy_spans("text", "base")).withColumn("spans", F.array_sort(F.concat("base", "entropy"))).select("doc_id", "text", "base", "spans")


def spans_text(column: str) -> Column:
    """kind:start:stop, comma-joined in the array's order."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({column}, x -> concat({names}[x.rank], ':', x.start, ':', x.stop)), ',')")


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """doc_id and text with every span replaced by mark; overlapping spans are replaced once."""
    cut = "aggregate(spans, named_struct('at', 0, 'out', ''), (s, x) -> if(x.stop <= s.at, s, named_struct('at', x.stop, 'out', concat(s.out, if(x.start >= s.at, concat(substring(text, s.at + 1, x.start - s.at), '{mark}'), '')))), s -> concat(s.out, substring(text, s.at + 1)))"
    return with_secret_spans(docs).select("doc_id", F.expr(cut.replace("{mark}", mark)).alias("text"))


def secret_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_entropy of every row."""
    count = lambda rank: F.expr(f"cast(size(filter(spans, x -> x.rank = {rank})) as bigint)")
    return with_secret_spans(docs).select("doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)), F.sha2(spans_text("base"), 256).alias("base_sha256"), spans_text("spans").alias("spans"))
