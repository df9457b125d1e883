"""Text, header and number columns with the semantics of the reference data: Unicode white space, ASCII tags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The code points that count as white space.
WHITE_SPACE = r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
TAG = r"^(GH|GT|PL|CE|AA|CBM)[0-9]+(_[0-9]+)?$"
BASE_FAMILY = r"^(GH|GT|PL|CE|AA|CBM)[0-9]+$"


def trim_space(text: Column) -> Column:
    """text without white space at its ends."""
    return F.regexp_replace(text, f"^[{WHITE_SPACE}]+|[{WHITE_SPACE}]+$", "")


def normalised_sequence(text: Column) -> Column:
    """Upper case, no white space, without one terminal stop symbol. Visible ASCII alone, which a pattern of one range tells
    far sooner than that of all white space, has nothing to take out."""
    solid = F.when(text.rlike(r"^[!-~]*+\z"), text).otherwise(F.regexp_replace(text, f"[{WHITE_SPACE}]+", ""))
    return F.regexp_replace(F.upper(solid), r"\*$", "")


def invalid_symbols(sequence: Column) -> Column:
    """Sorted distinct characters outside A-Z."""
    left = F.regexp_replace(sequence, "[A-Z]", "")
    return F.array_sort(F.array_distinct(F.filter(F.split(left, ""), lambda x: x != "")))


def sequence_problem(text: Column, identifier: Column) -> Column:
    """Why a sequence can't be used, or null."""
    clean = normalised_sequence(text)
    return (
        F.when(text.isNull(), F.concat(F.lit("sequence is not text: "), identifier))
        .when(clean == "", F.concat(F.lit("sequence is empty: "), identifier))
        .when(~clean.rlike("^[A-Z]+$"), F.concat(F.lit("invalid symbols "), F.array_join(invalid_symbols(clean), ", "), F.lit(" in "), identifier))
    )


def identifier_problem(identifier: Column) -> Column:
    clean = trim_space(identifier)
    return F.when(identifier.isNull() | (clean == ""), F.lit("identifier is empty")).when(clean.rlike(f"[{WHITE_SPACE}]"), F.concat(F.lit("identifier holds white space: "), clean))


def profile_name(name: Column) -> Column:
    """Trimmed, without one trailing .hmm."""
    return F.regexp_replace(trim_space(name), r"\.hmm$", "")


def header_fields(header: Column) -> Column:
    """The trimmed fields of a header line, without its leading >."""
    line = trim_space(F.regexp_replace(trim_space(header), "^>", ""))
    return F.transform(F.split(line, r"\|"), trim_space)


def is_tag(field: Column) -> Column:
    return field.rlike(TAG)


def header_tags(fields: Column) -> Column:
    """Sorted distinct family tags among the fields."""
    return F.array_sort(F.array_distinct(F.filter(fields, is_tag)))


def header_accession(fields: Column) -> Column:
    """Field 0; behind a leading tag all fields that are no tags, joined by |."""
    others = F.filter(fields, lambda x: ~is_tag(x))
    return F.when(is_tag(fields[0]), F.array_join(others, "|")).otherwise(fields[0])


def header_problem(header: Column) -> Column:
    """Why a header can't be used, or null."""
    fields = header_fields(header)
    empty = F.concat(F.lit("header is empty: "), F.coalesce(header, F.lit("")))
    return (
        F.when(header.isNull() | (F.array_join(fields, "|") == ""), empty)
        .when(F.exists(fields, lambda x: x == ""), F.concat(F.lit("header has an empty field: "), header))
        .when(header_accession(fields) == "", F.concat(F.lit("header has no accession: "), header))
    )


def base_family(tag: Column) -> Column:
    return F.split_part(trim_space(tag), F.lit("_"), F.lit(1))


def has_family(tags: Column, family: str) -> Column:
    return F.exists(tags, lambda t: base_family(t) == family)


def has_any_family(tags: Column, families: list[str]) -> Column:
    return F.exists(tags, lambda t: base_family(t).isin(families))


def finite(number: Column) -> Column:
    return number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))


def number(text: Column) -> Column:
    """A double from text, null where it is none. Java's type suffixes are no numbers; _ and other digits neither."""
    clean = trim_space(text)
    return F.when(~clean.rlike("(?<![iI][nN])[dDfF]$"), clean.try_cast("double"))
