"""Name normalisation and similarity. Column expressions where SQL reaches; Arrow kernels elsewhere."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Street-type words and their short forms, applied in this order.
ABBREVIATIONS = (
    ("street", "st"), ("avenue", "ave"), ("road", "rd"), ("drive", "dr"), ("lane", "ln"), ("boulevard", "blvd"),
    ("court", "ct"), ("place", "pl"), ("highway", "hwy"), ("parkway", "pkwy"), ("square", "sq"), ("terrace", "ter"),
    ("north", "n"), ("south", "s"), ("east", "e"), ("west", "w"),
)
GENERIC = r"^(unnamed.*|ramp|service road|driveway|alley|path|footpath|sidewalk|cycleway|track|access road|parking aisle)$"


def present(name: Column) -> Column:
    """1 for a name with something in it, else 0."""
    return F.when(F.length(F.trim(F.coalesce(name, F.lit("")))) > 0, 1.0).otherwise(0.0)


def normalise(name: Column) -> Column:
    """Lower case, punctuation out, leading saint spelled out, street types shortened, single blanks."""
    s = F.lower(F.trim(name))
    s = F.regexp_replace(F.regexp_replace(s, r"[.,]", ""), "-", " ")
    s = F.regexp_replace(s, r"^st ", "saint ")
    for word, short in ABBREVIATIONS:
        s = F.regexp_replace(s, rf"\b{word}\b", short)
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def generic(name: Column) -> Column:
    return F.when(F.lower(F.trim(F.coalesce(name, F.lit("")))).rlike(GENERIC), 1.0).otherwise(0.0)


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & full
    return bin(full & ~row).count("1")


def indel(a: str, b: str) -> float:
    """2 LCS / (|a| + |b|); 1 for two empty strings."""
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def jaro_winkler(a: str, b: str) -> float:
    if not a or not b:
        return 1.0 if a == b else 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used = [False] * len(b)
    left = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    swaps = sum(x != y for x, y in zip(left, (c for c, u in zip(b, used, strict=True) if u), strict=True)) / 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro) if jaro > 0.7 else jaro


def token_sort(a: str, b: str) -> float:
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """Best ratio of the common words against either side's words."""
    x, y = set(a.split()), set(b.split())
    both, only_a, only_b = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not only_a or not only_b):
        return 1.0
    one, two = f"{both} {only_a}".strip(), f"{both} {only_b}".strip()
    return max(indel(one, two), *((indel(both, one), indel(both, two)) if both else (0.0,)))


def partial(a: str, b: str) -> float:
    """Best ratio of the shorter string against windows of the longer one."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 1.0 if not long else 0.0
    return max(indel(short, long[i : i + len(short)]) for i in range(len(long) - len(short) + 1))


def _kernel(f: Callable[[str, str], float]) -> Callable[[Column, Column], Column]:
    @F.pandas_udf(DoubleType())
    def apply(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[tuple[str, str], float] = {}
        out = []
        for p in zip(a, b, strict=True):
            if p[0] is None or p[1] is None:
                out.append(None)
                continue
            if p not in known:
                known[p] = f(*p)
            out.append(known[p])
        return pd.Series(out, dtype="float64")

    return apply


indel_ratio, jaro_winkler_similarity, token_sort_ratio, token_set_ratio, partial_ratio = map(_kernel, (indel, jaro_winkler, token_sort, token_set, partial))


def metaphone_key(word: str) -> str:
    """A consonant key: silent and equal-sounding letters folded."""
    w = "".join(c for c in word.upper() if "A" <= c <= "Z")
    for old, new in (("PH", "F"), ("GH", "G"), ("KN", "N"), ("WR", "R"), ("CK", "K"), ("SCH", "SK"), ("SH", "X"), ("CH", "X"), ("TH", "0"), ("Q", "K"), ("Z", "S"), ("V", "F"), ("DG", "J")):
        w = w.replace(old, new)
    out = ""
    for i, c in enumerate(w):
        if c in "AEIOU" and i or c in "HWY" and i or out[-1:] == c:
            continue
        out += ("S" if w[i + 1 : i + 2] in ("E", "I") else "K") if c == "C" else c
    return out


@F.pandas_udf(StringType())
def metaphone(names: pd.Series) -> pd.Series:
    return names.map(lambda s: None if s is None else " ".join(metaphone_key(w) for w in s.split()))


def script_of(name: Column) -> Column:
    """The scripts of a name's letters, as a sorted array."""
    kinds = ("Latin", "Cyrillic", "Greek", "Han", "Hiragana", "Katakana", "Hangul", "Arabic", "Hebrew", "Thai", "Devanagari")
    return F.array_compact(F.array(*[F.when(name.rlike(rf"\p{{Is{k}}}"), F.lit(k)) for k in kinds]))


def cross_script(a: Column, b: Column) -> Column:
    """True where both names have letters and share no script."""
    x, y = script_of(a), script_of(b)
    return (F.size(x) > 0) & (F.size(y) > 0) & ~F.arrays_overlap(x, y)


def route_of(name: Column) -> Column:
    """Canonical route ("interstate 90"), or null."""
    s = F.lower(F.trim(name))
    number = F.regexp_extract(s, r"(\d+)", 1)
    kind = (
        F.when(s.rlike(r"^(i|interstate)[ -]?\d+"), "interstate").when(s.rlike(r"^(us|u\.s\.)( highway| route| hwy)?[ -]?\d+"), "us")
        .when(s.rlike(r"^(state route|state highway|sr|sh)[ -]?\d+"), "state").when(s.rlike(r"^(county road|cr)[ -]?\d+"), "county").when(s.rlike(r"^(route|rte|highway|hwy)[ -]?\d+"), "route")
    )
    return F.when(kind.isNotNull(), F.concat_ws(" ", kind, number))


def numeric_suffix(name: Column) -> Column:
    """The last number of a name that is no ordinal, as text."""
    found = F.regexp_extract_all(name, F.lit(r"(\d+)(?!\d|st\b|nd\b|rd\b|th\b)"), F.lit(1))
    return F.get(found, F.size(found) - 1)


def longest_word(name: Column) -> Column:
    """The longest word that is no street type, the first of equals."""
    types = [w for p in ABBREVIATIONS for w in p]
    words = F.filter(F.split(normalise(name), " "), lambda w: ~w.isin(types) & (w != ""))
    best = F.array_max(F.transform(words, lambda w, i: F.struct(F.length(w).alias("n"), (-i).alias("i"), w.alias("w"))))
    return best["w"]


def numeric_match(a: Column, b: Column) -> Column:
    """1 or 0 for equal or unequal route numbers; null where either name has none."""
    x, y = numeric_suffix(a).cast("long"), numeric_suffix(b).cast("long")
    return F.when(x.isNotNull() & y.isNotNull(), F.when(x == y, 1.0).otherwise(0.0))


def route_number(name: Column) -> Column:
    """The digits of a numbered route's name, or null for a name that is none."""
    found = F.regexp_extract(F.lower(F.coalesce(name, F.lit(""))), r"\b(?:i|us|sr|hwy|rte|interstate|route|highway)(?: route| highway| hwy)?[ -]?(\d+)\b", 1)
    return F.when(found != "", found)


def names_compatible(a: Column, b: Column) -> Column:
    """True for equal names or equal route numbers, false for other pairs of names, null where one is missing."""
    named = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")
    return F.when(named, (F.lower(F.trim(a)) == F.lower(F.trim(b))) | F.coalesce(route_number(a) == route_number(b), F.lit(False)))


ROUTE_WORDS = r"interstate|highway|route|us|sr|i-|hwy"


def likely_same(a: Column, b: Column) -> Column:
    """Quick test for two names of one road: equal, equal when normalised, sharing nearly all words, or numbered alike."""
    named = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")
    alike = (normalise(a) == normalise(b)) | (token_set_ratio(normalise(a), normalise(b)) >= 0.9)
    routes = F.coalesce(numeric_suffix(a).cast("long") == numeric_suffix(b).cast("long"), F.lit(False)) & F.lower(a).rlike(ROUTE_WORDS) & F.lower(b).rlike(ROUTE_WORDS)
    return F.coalesce(named & (alike | routes), F.lit(False))


#: What a bundle of name similarities holds, besides flags; null where names can't be compared.
MEASURES = ("indel", "jaro_winkler", "token_sort", "token_set", "partial", "soundex", "metaphone")


def name_bundle(a: Column, b: Column) -> dict[str, Column]:
    """Similarities and flags of two names.

    Similarities are null where either name is missing or nothing but punctuation, or where the names
    share no script; soundex and metaphone also where either has letters that aren't Latin.
    """
    x, y = normalise(a), normalise(b)
    has_a, has_b = present(a), present(b)
    known = (has_a == 1) & (has_b == 1) & (F.length(x) > 0) & (F.length(y) > 0)
    usable = known & ~cross_script(x, y)
    latin = usable & (F.size(F.array_except(F.array_union(script_of(x), script_of(y)), F.array(F.lit("Latin")))) == 0)
    scores = (indel_ratio(x, y), jaro_winkler_similarity(x, y), token_sort_ratio(x, y), token_set_ratio(x, y), partial_ratio(x, y))
    sounds = (F.when(F.soundex(longest_word(a)) == F.soundex(longest_word(b)), 1.0).otherwise(0.0), indel_ratio(metaphone(x), metaphone(y)))
    out = {m: F.when(usable, s) for m, s in zip(MEASURES, scores, strict=False)} | {m: F.when(latin, s) for m, s in zip(MEASURES[5:], sounds, strict=True)}
    generic_name = F.when(known & ((generic(a) == 1) | (generic(b) == 1)), 1.0).otherwise(0.0)
    return out | {"has_name_ref": has_a, "has_name_target": has_b, "names_missing": ~known, "name_is_generic": generic_name}


def variants(primary: Column, common: Column, rules: Column) -> Column:
    """All names of a segment in the order primary, by language, by rule; equal ones but for case come once."""
    listed = F.array_compact(F.concat(F.array(primary), F.coalesce(F.map_values(common), F.array().cast("array<string>")), F.coalesce(F.transform(rules, lambda r: r["value"]), F.array().cast("array<string>"))))
    kept = F.filter(listed, lambda v: v != "")
    return F.filter(kept, lambda v, i: ~F.exists(F.slice(kept, 1, i), lambda o: F.lower(o) == F.lower(v)))


def best_variants(rows, key: str, ref: str, target: str):
    """key, ref_name, target_name, ratio: the most alike pair of two arrays of names; of equal pairs the first in order.

    A side without names gives null there and the other side's first name.
    """
    long = rows.select(key, F.posexplode_outer(ref).alias("i", "r"), target).select(key, "i", "r", F.posexplode_outer(target).alias("j", "t"))
    scored = long.withColumn("ratio", indel_ratio(normalise(F.col("r")), normalise(F.col("t"))))
    order = F.struct(F.coalesce("ratio", F.lit(-1.0)).alias("s"), (-F.coalesce("i", F.lit(0))).alias("i"), (-F.coalesce("j", F.lit(0))).alias("j"))
    best = scored.groupBy(key).agg(F.max_by(F.struct("r", "t", "ratio"), order).alias("m"))
    return best.select(key, F.col("m.r").alias("ref_name"), F.col("m.t").alias("target_name"), "m.ratio")
