"""Scalar functions over Columns; all of them stay inside the JVM."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# They define identifiers, alphabets and classes, and must be as they are.
STABLE_ID = r"^(ENS[GPT][0-9]+)(\.[0-9]+)?$"
RESIDUES = "ACDEFGHIKLMNPQRSTVWYBXZJUO"
SPECIAL_TRANSLATED = ("nonsense_mediated_decay", "non_stop_decay", "protein_coding_LoF", "polymorphic_pseudogene")
ACCESSIONS = (r"^[A-Z]{2}\d+\.\d+$", r"^H3\.[A-Z]$")
IDENTIFIERS = ((r"^LOC\d+$", "loc_identifier"), ("^(LINC|MIR|SNOR|RNU)", "noncoding_like"))
LENGTH_BINS = ((0, 512), (513, 1022), (1023, 1500), (1501, 2000), (2001, 3000), (3001, 5000), (5001, 1_000_000_000))


def stable_id(c: Column) -> Column:
    """The id without its version, where the whole id has that form; otherwise unchanged; '' is null."""
    # A final line break goes with the version, as $ stands before it.
    return F.nullif(F.regexp_replace(c, STABLE_ID[:-1] + r"(?:\r\n|[\n\r\x{85}\x{2028}\x{2029}])?\z", "$1"), F.lit(""))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once: an expression used in a lambda is otherwise worked out for each of its elements."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def attributes(c: Column) -> Column:
    """`key "value"` pairs as a map; of a repeated key the last value counts.

    Does not depend on the session's policy for repeated keys. Where a key is repeated, pairs are sorted, so work
    grows with their number.
    """
    # As (\S+)\s+"([^"]*)", but tried at the start of a word or where the last pair ended, and never taken back.
    pattern = F.lit(r'(?:(?<!\S)|\G)(\S++)\s++"([^"]*+)"')
    keys, values = F.regexp_extract_all(c, pattern, F.lit(1)), F.regexp_extract_all(c, pattern, F.lit(2))

    def last(ordered: Column) -> Column:
        ends = F.filter(ordered, lambda p, i: ~F.get(ordered, i + 1)["k"].eqNullSafe(p["k"]))
        return F.map_from_entries(F.transform(ends, lambda p: F.struct(p["k"].alias("key"), p["v"].alias("value"))))

    def map_of(found: Column) -> Column:
        k, v = found["k"], found["v"]
        pairs = F.transform(F.arrays_zip(k.alias("k"), v.alias("v")), lambda p, i: F.struct(p["k"].alias("k"), i.alias("i"), p["v"].alias("v")))
        return F.when(F.size(F.array_distinct(k)) == F.size(k), F.map_from_arrays(k, v)).otherwise(bound(F.sort_array(pairs), last))

    return bound(F.struct(keys.alias("k"), values.alias("v")), map_of)


#: Attributes after a blank, of which the text tells any without a map: each quote that opens stands after one blank and a word, each
#: that closes after no blank and before ; and a blank or the end.
PLAIN_ATTRIBUTES = r'^ (?:(?:[^"\s]++ )++"[^"]*+(?<!\s)";(?: |\z))++[^"]*+\z'


def attribute(*keys: str, text: str = "text", odd: str = "odd") -> Column:
    """The value of the first key that is there and not empty, else '': from odd, a map as of attributes(), or else from text.

    Where odd is null, text must be as PLAIN_ATTRIBUTES says; what is a key there can't be part of a value.
    """
    def told(key: str) -> Column:
        mark = f' {key} "'
        return F.when(F.contains(text, F.lit(mark)), F.substring_index(F.substring_index(text, mark, -1), '"', 1)).otherwise("")

    plain = F.coalesce(*[F.nullif(told(k), F.lit("")) for k in keys[:-1]], told(keys[-1]))
    return F.when(F.col(odd).isNull(), plain).otherwise(first_attribute(F.col(odd), *keys))


def first_attribute(attrs: Column, *keys: str) -> Column:
    """The value of the first key that is there and not empty, else ''."""
    return F.coalesce(*[F.nullif(F.try_element_at(attrs, F.lit(k)), F.lit("")) for k in keys], F.lit(""))


def sequence_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def accession_like(c: Column) -> Column:
    return c.rlike(ACCESSIONS[0]) | c.rlike(ACCESSIONS[1])


def pipe_list(c: Column) -> Column:
    """Trimmed, non-empty parts of a pipe-separated value; null gives an empty array."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def invalid_residues(sequence: Column) -> Column:
    """The distinct characters outside the alphabet, sorted."""
    rest = F.regexp_replace(F.coalesce(sequence, F.lit("")), f"[{RESIDUES}]+", "")
    return F.array_sort(F.array_remove(F.array_distinct(F.split(rest, "")), ""))


def sequence_issue(sequence: Column) -> Column:
    """'empty_sequence', the invalid characters joined by ';', or ''."""
    empty = F.length(F.trim(F.coalesce(sequence, F.lit("")))) == 0
    found = F.when(empty, F.lit("empty_sequence")).otherwise(F.array_join(invalid_residues(sequence), ";"))
    return F.when((sequence != "") & ~sequence.rlike(f"[^{RESIDUES}]"), F.lit("")).otherwise(found)  # nearly all are in order


def locus_class(c: Column) -> Column:
    """Class of a sequence region by ordered rules."""
    name = F.coalesce(c, F.lit(""))
    upper = F.upper(name)
    return (
        F.when(name.rlike(r"(?i)^chr([1-9]|1[0-9]|2[0-2]|X|Y|M)$"), "primary_reference")
        .when(upper.contains("PATCH"), "patch")
        .when(upper.rlike("^(KI|GL|JH|HSCHR|ALT_REF)"), "alternate_locus")
        .when(upper.rlike("^(HLA-|HG|NA_)") | upper.contains("HAP"), "haplotype")
        .when(upper.rlike("^(NW_|NT_|NG_|NZ_)"), "scaffold")
        .otherwise("other")
    )


def stop_class(sequence: Column) -> Column:
    s = F.coalesce(sequence, F.lit(""))
    stops = F.length(s) - F.length(F.replace(s, F.lit("*"), F.lit("")))
    return (
        F.when(stops == 0, "none")
        .when(stops > 1, "multiple_stops")
        .when(s.endswith("*"), "terminal_stop")
        .otherwise("internal_stop")
    )


def stop_positions(sequence: Column, mark: str = "*") -> Column:
    """1-based places of the mark, joined by commas."""
    letters = F.split(F.coalesce(sequence, F.lit("")), "")
    places = F.transform(letters, lambda x, i: F.when(x == mark, i + 1))
    return F.array_join(F.transform(F.array_compact(places), lambda x: x.cast("string")), ",")


def biotype_policy(c: Column) -> Column:
    return (
        F.when(c == "protein_coding", "ordinary_protein_coding")
        .when(c.isin(*SPECIAL_TRANSLATED), "special_translated")
        .otherwise("other_transcript_type")
    )


def eligibility(protein_id: Column, found: Column, valid: Column, issue: Column, kind: Column) -> Column:
    """Why a transcript's sequence is not a candidate; '' if it is one."""
    typed = F.when(F.coalesce(kind, F.lit("")) == "", F.lit("missing_transcript_type")).otherwise(kind)
    return (
        F.when(F.coalesce(protein_id, F.lit("")) == "", "no_translation")
        .when(~found, "sequence_not_in_fasta")
        .when(~valid, F.concat(F.lit("invalid_sequence:"), issue))
        .when(kind == "protein_coding", "")
        .otherwise(F.concat(F.lit("requires_policy_review:"), typed))
    )


def identifier_class(c: Column) -> Column:
    upper = F.upper(c)
    rules = F.when(accession_like(c), "accession_like")
    for pattern, kind in IDENTIFIERS:
        rules = rules.when(upper.rlike(pattern), kind)
    return (
        rules.when(upper.endswith("P") | upper.contains("PSEUDO"), "pseudogene_like")
        .otherwise("standard_symbol")
    )


def length_bin(c: Column) -> Column:
    """Number (from 0) of the right-closed bin that a length falls into; null for none."""
    chain = None
    for k, (low, high) in enumerate(LENGTH_BINS):
        inside = c.between(low, high)
        chain = F.when(inside, F.lit(k)) if chain is None else chain.when(inside, F.lit(k))
    return chain


def bin_label(k: Column) -> Column:
    labels = F.array(*[F.lit(f"{low}-{high}" if high < 10**9 else f">{low - 1}") for low, high in LENGTH_BINS])
    return F.get(labels, k)


def true_text(c: Column) -> Column:
    """Whether a boolean, or its name in any case, is true; null is not."""
    return F.coalesce(F.lower(c.cast("string")) == "true", F.lit(False))


def gib(count: Column, dim: int, width: int) -> Column:
    return count.cast("bigint") * dim * width / float(1 << 30)


def chunk_starts(length: Column, window: int, overlap: int) -> Column:
    """Starts of windows that cover a length: every window - overlap, and one that ends at the end."""
    if not 0 < overlap < window:
        raise ValueError(f"an overlap of {overlap} does not fit windows of {window}")
    last = (length - window).cast("int")
    many = F.array_distinct(F.concat(F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(window - overlap)), F.array(last)))
    return F.when(length <= window, F.array(F.lit(0))).otherwise(many)


#: Tapers by name, of a place x between -1 and 1 and the window's size; m has abs, cos and at_least.
TAPERS = {
    "uniform": lambda m, x, size: 0.0 * x + 1.0,
    "triangular": lambda m, x, size: m.at_least(1.0 - m.abs(x), 1.0 / size),
    "cosine": lambda m, x, size: m.at_least(0.5 + 0.5 * m.cos(math.pi * x), 1e-3),
}
TAPERS["hann"] = TAPERS["cosine"]


class ColumnMath:
    """What TAPERS need, on Columns."""

    abs, cos = staticmethod(F.abs), staticmethod(F.cos)

    @staticmethod
    def at_least(x: Column, least: Column | float) -> Column:
        return F.greatest(x, least if isinstance(least, Column) else F.lit(least))


def taper_named(kind: str):
    if kind not in TAPERS:
        raise ValueError(f"unknown taper: {kind}")
    return TAPERS[kind]


def taper(size: Column, kind: str) -> Column:
    """Weights of a window's places: uniform, triangular, or cosine (also called hann)."""
    value = taper_named(kind)

    def at(i: Column) -> Column:
        x = F.when(size <= 1, F.lit(-1.0)).otherwise(-1.0 + F.lit(2.0) * i / F.greatest(size - 1, F.lit(1)))
        return value(ColumnMath, x, size)

    return F.transform(F.sequence(F.lit(0), size.cast("int") - 1), at)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def max_abs_error(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))))


def mean_abs_error(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))) / F.size(a)


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2))))


def relative_l2(a: Column, b: Column) -> Column:
    return F.try_divide(l2_distance(a, b), norm(b))


def js_divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon divergence of two weight arrays; the midpoint is held above 1e-12."""
    def part(x: Column, y: Column) -> Column:
        middle = F.greatest((x + y) / 2, F.lit(1e-12))
        return F.when(x > 0, x * F.log(x / middle)).otherwise(F.lit(0.0))

    return 0.5 * (_sum(F.zip_with(p, q, part)) + _sum(F.zip_with(q, p, part)))


def js_distance(p: Column, q: Column) -> Column:
    return F.sqrt(F.greatest(js_divergence(p, q), F.lit(0.0)))


def entropy(w: Column) -> Column:
    return _sum(F.transform(w, lambda x: -x * F.log(F.greatest(x, F.lit(1e-12)))))


def all_finite(a: Column) -> Column:
    return F.coalesce(F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
