"""Pairwise similarities: twenty features of two records."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import number_set, token_set, words

# The features' names in their order.
FEATURES = (
    "name_ratio", "name_partial_ratio", "name_token_sort", "name_token_set", "name_wratio", "name_jaro_winkler", "name_token_jaccard",
    "name_token_overlap", "name_lev_sim", "name_len_diff_ratio", "addr_ratio", "addr_partial_ratio", "addr_token_sort", "addr_token_set",
    "addr_token_jaccard", "addr_token_overlap", "addr_common_numbers", "addr_len_diff_ratio", "addr_one_empty", "country_match",
)

# Scalars on Python strings; the column forms below batch them through Arrow.


def _masks(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(text):
        out[c] = out.get(c, 0) | 1 << i
    return out


def _lcs(masks: dict[str, int], size: int, other: str) -> int:
    """Length of the longest common subsequence, one bit for each character of the first text."""
    full = (1 << size) - 1
    row = full
    for c in other:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Normalised similarity by insertions and deletions: 2 LCS / (|a| + |b|); 0 if either is empty."""
    if not a or not b:
        return 0.0
    return 1.0 if a == b else 2 * _lcs(_masks(a), len(a), b) / (len(a) + len(b))


def _best_window(short: str, long: str) -> float:
    masks, wanted, m = _masks(short), Counter(short), len(short)
    have: Counter = Counter()
    common, best = 0, 0.0
    for end in range(1, len(long) + m):
        # The window is long[end - m : end], cut at the ends; only windows that could win are aligned.
        if end <= len(long):
            c = long[end - 1]
            have[c] += 1
            common += have[c] <= wanted[c]
        if end > m:
            c = long[end - m - 1]
            common -= have[c] <= wanted[c]
            have[c] -= 1
        window = long[max(0, end - m) : end]
        if 2 * common / (m + len(window)) > best:
            best = max(best, 2 * _lcs(masks, m, window) / (m + len(window)))
            if best == 1.0:
                break
    return best


def partial_ratio(a: str, b: str) -> float:
    """Best ``ratio`` of the shorter text with any window of the longer; both ways at equal lengths."""
    if not a or not b:
        return 0.0
    if a in b or b in a:
        return 1.0
    if len(a) == len(b):
        return max(_best_window(a, b), _best_window(b, a))
    return _best_window(*sorted((a, b), key=len))


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def _parts(a: str, b: str) -> tuple[str, str, str]:
    x, y = set(a.split()), set(b.split())
    return " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))


def token_set_ratio(a: str, b: str) -> float:
    """Similarity of shared tokens with each side's own ones added."""
    if not a or not b:
        return 0.0
    both, left, right = _parts(a, b)
    if both and not (left and right):
        return 1.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    return max(ratio(one, two), ratio(both, one), ratio(both, two)) if both else ratio(one, two)


def weighted_ratio(a: str, b: str) -> float:
    """The best of plain, partial and token ratios, weighted by how much the lengths differ."""
    if not a or not b:
        return 0.0
    stretch = max(len(a), len(b)) / min(len(a), len(b))
    if stretch < 1.5:
        return max(ratio(a, b), 0.95 * max(token_sort(a, b), token_set_ratio(a, b)))
    scale = 0.9 if stretch <= 8 else 0.6
    both, left, right = _parts(a, b)
    tokens = 1.0 if both else partial_ratio(left, right)
    tokens = max(tokens, partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))))
    return max(ratio(a, b), scale * partial_ratio(a, b), 0.95 * scale * tokens)


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity; above 0.7, lifted by a common prefix of up to four characters."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken, left = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    if not left:
        return 0.0
    right = [c for c, t in zip(b, taken) if t]
    m, swapped = len(left), sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return jaro + 0.1 * prefix * (1 - jaro) if jaro > 0.7 else jaro


# The same for many pairs at once: pairs are the axis of the arrays, one bit of a 64-bit word for each character
# of the first text. Pairs whose first text is longer take the functions above.

_WORD = 64
_CHUNK = 2_000
Pairs = list[tuple[str, str]]


def _codes(texts: list[str], width: int) -> np.ndarray:
    """Characters as numbers, filled up with zeros."""
    out = np.zeros((len(texts), width), np.uint32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _hits(first: list[str], second: list[str]) -> np.ndarray:
    """For each character of the second text, the places of the first text that hold it, as bits; zero beyond its end."""
    x, y = _codes(first, _WORD), _codes(second, max(1, max(map(len, second))))
    out = np.zeros(y.shape, np.uint64)
    for i in range(max(1, max(map(len, first)))):
        out |= np.where((x[:, i, None] == y) & (y != 0), np.uint64(1) << np.uint64(i), np.uint64(0))
    return out


def _full(sizes: np.ndarray) -> np.ndarray:
    return np.where(sizes >= _WORD, np.uint64(2**64 - 1), (np.uint64(1) << (sizes % _WORD).astype(np.uint64)) - np.uint64(1))


def _fits(pair: tuple[str, str]) -> bool:
    return len(pair[0]) <= _WORD and "\0" not in pair[0] and "\0" not in pair[1]


def _ratios(pairs: Pairs) -> np.ndarray:
    """``ratio`` of each pair."""
    out = np.array([float(bool(a) and a == b) for a, b in pairs])
    ordered = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs]  # a symmetric value
    open_ = [i for i, (a, b) in enumerate(ordered) if a and a != b]
    for i in open_:
        if not _fits(ordered[i]):
            out[i] = ratio(*ordered[i])
    open_ = sorted((i for i in open_ if _fits(ordered[i])), key=lambda i: len(ordered[i][1]))
    for begin in range(0, len(open_), _CHUNK):
        at = open_[begin : begin + _CHUNK]
        first, second = [ordered[i][0] for i in at], [ordered[i][1] for i in at]
        m, n = (np.fromiter(map(len, t), np.int64, len(at)) for t in (first, second))
        full = _full(m)
        row = full.copy()
        for hit in _hits(first, second).T:
            hit = row & hit
            row = ((row + hit) | (row - hit)) & full
        out[at] = 2 * (m - np.bitwise_count(row)) / (m + n)
    return out


def _best_windows(pairs: Pairs) -> np.ndarray:
    """``_best_window`` of each pair (shorter, longer): all windows of all pairs step by step."""
    out = np.zeros(len(pairs))
    for i, pair in enumerate(pairs):
        if not _fits(pair):
            out[i] = _best_window(*pair)
    order = sorted((i for i, pair in enumerate(pairs) if _fits(pair)), key=lambda i: (len(pairs[i][0]), len(pairs[i][1])))
    while order:
        # Pairs of one size of the shorter text, in bounded arrays.
        m = len(pairs[order[0]][0])
        same = next((k for k, i in enumerate(order) if len(pairs[i][0]) != m), len(order))
        longest = len(pairs[order[same - 1]][1])
        at, order = order[: max(1, min(same, 200_000 // (longest + m)))], order[max(1, min(same, 200_000 // (longest + m))) :]
        first, second = [pairs[i][0] for i in at], [pairs[i][1] for i in at]
        n = np.fromiter(map(len, second), np.int64, len(at))
        hits = _hits(first, second)
        width = hits.shape[1]
        padded = np.zeros((len(at), width + 2 * (m - 1)), np.uint64)
        padded[:, m - 1 : m - 1 + width] = hits
        full = _full(np.array([m]))[0]
        row = np.full((len(at), width + m - 1), full)
        for t in range(m):
            hit = row & padded[:, t : t + width + m - 1]
            row = ((row + hit) | (row - hit)) & full
        start = np.arange(width + m - 1) - (m - 1)
        size = np.minimum(start + m, n[:, None]) - np.maximum(start, 0)
        score = np.where(size > 0, 2 * (m - np.bitwise_count(row).astype(np.int64)) / (m + np.maximum(size, 1)), 0.0)
        out[at] = score.max(axis=1)
    return out


def _partials(pairs: Pairs) -> np.ndarray:
    """``partial_ratio`` of each pair."""
    out = np.array([float(bool(a) and bool(b) and (a in b or b in a)) for a, b in pairs])
    open_ = [i for i, (a, b) in enumerate(pairs) if a and b and not out[i]]
    ordered = [tuple(sorted(pairs[i], key=len)) for i in open_]
    out[open_] = _best_windows(ordered)
    even = [k for k, (a, b) in enumerate(ordered) if len(a) == len(b)]
    if even:
        at = [open_[k] for k in even]
        out[at] = np.maximum(out[at], _best_windows([ordered[k][::-1] for k in even]))
    return out


def _aligned(pairs: Pairs, kinds: tuple[str, ...]) -> dict[str, np.ndarray]:
    """The alignment similarities named, of all pairs."""
    out: dict[str, np.ndarray] = {}
    wanted = set(kinds)
    weighted = "wratio" in wanted
    some = np.array([bool(a) and bool(b) for a, b in pairs])
    if wanted & {"ratio", "wratio"}:
        out["ratio"] = _ratios(pairs)
    if wanted & {"token_sort", "wratio"}:
        ordered = [(" ".join(sorted(a.split())), " ".join(sorted(b.split()))) for a, b in pairs]
        out["token_sort"] = _ratios(ordered)
    if wanted & {"token_set", "wratio"}:
        parts = [_parts(a, b) for a, b in pairs]
        one, two = ([f"{p[0]} {p[k]}".strip() for p in parts] for k in (1, 2))
        both = [p[0] for p in parts]
        best = np.maximum.reduce([_ratios(list(zip(x, y))) for x, y in ((one, two), (both, one), (both, two))])
        inside = np.array([bool(p[0]) and not (p[1] and p[2]) for p in parts])
        out["token_set"] = np.where(some, np.where(inside, 1.0, best), 0.0)
    if "partial_ratio" in wanted:
        out["partial_ratio"] = _partials(pairs)
    if weighted:
        stretch = np.array([max(len(a), len(b)) / min(len(a), len(b)) if a and b else 1.0 for a, b in pairs])
        value = np.maximum(out["ratio"], 0.95 * np.maximum(out["token_sort"], out["token_set"]))
        far = np.flatnonzero(stretch >= 1.5)
        if len(far):
            scale = np.where(stretch[far] <= 8, 0.9, 0.6)
            plain = out["partial_ratio"][far] if "partial_ratio" in out else _partials([pairs[i] for i in far])
            tokens = np.array([float(bool(parts[i][0])) for i in far])
            tokens = np.maximum(tokens, _partials([parts[i][1:] if not parts[i][0] else ("", "") for i in far]))
            tokens = np.maximum(tokens, _partials([ordered[i] for i in far]))
            value[far] = np.maximum.reduce([out["ratio"][far], scale * plain, 0.95 * scale * tokens])
        out["wratio"] = np.where(some, value, 0.0)
    if "jaro_winkler" in wanted:
        out["jaro_winkler"] = np.array([jaro_winkler(a, b) for a, b in pairs])
    return {k: out[k] for k in kinds}


def aligned(a: Column, b: Column, *kinds: str) -> Column:
    """Struct of the alignment similarities named; all of them in one pass over Arrow batches, equal pairs once."""

    @F.pandas_udf(", ".join(f"{k} double" for k in kinds))
    def run(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        place: dict[tuple[str, str], int] = {}
        at = [place.setdefault(pair, len(place)) for pair in zip(left.fillna(""), right.fillna(""))]
        found = _aligned(list(place), kinds)
        return pd.DataFrame({k: found[k][at] if at else np.zeros(0) for k in kinds})

    return run(a, b)


# Column expressions


def _both(a: Column, b: Column, value: Column) -> Column:
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(value)


def set_jaccard(x: Column, y: Column) -> Column:
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / union)


def token_jaccard(a: Column, b: Column) -> Column:
    return _both(a, b, set_jaccard(token_set(a), token_set(b)))


def token_overlap(a: Column, b: Column) -> Column:
    return _both(a, b, F.size(F.array_intersect(token_set(a), token_set(b))).cast("double"))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    return _both(a, b, 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def length_difference(a: Column, b: Column) -> Column:
    """Share of the longer length; 0 if both are empty, 1 if one is."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(0.0)).otherwise(F.abs(F.length(a) - F.length(b)) / longest)


def common_numbers(a: Column, b: Column) -> Column:
    """Jaccard of the numbers: 1 if neither text has one, 0 if one has none or either text is empty."""
    x, y = number_set(a), number_set(b)
    value = F.when((F.size(x) == 0) & (F.size(y) == 0), F.lit(1.0)).when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(set_jaccard(x, y))
    return _both(a, b, value)


def one_empty(a: Column, b: Column) -> Column:
    return ((a == "") != (b == "")).cast("double")


def country_match(a: Column, b: Column) -> Column:
    x, y = (F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in (a, b))
    return _both(x, y, (x == y).cast("double"))


def vector_cosine(a: Column, b: Column) -> Column:
    """Inner product of two normalised vectors, 0 where one is missing."""
    product = F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0).cast("double"), lambda s, x: s + x)
    return F.coalesce(product, F.lit(0.0))


def sorted_tokens(text: Column) -> Column:
    return F.array_join(F.array_sort(words(text)), " ")


def name_similarities(a: Column, b: Column) -> dict[str, Column]:
    found = aligned(a, b, "ratio", "partial_ratio", "token_sort", "token_set", "wratio", "jaro_winkler")
    return {f"name_{k}": found[k] for k in ("ratio", "partial_ratio", "token_sort", "token_set", "wratio", "jaro_winkler")} | {
        "name_token_jaccard": token_jaccard(a, b),
        "name_token_overlap": token_overlap(a, b),
        "name_lev_sim": levenshtein_similarity(a, b),
        "name_len_diff_ratio": length_difference(a, b),
    }


def address_similarities(a: Column, b: Column) -> dict[str, Column]:
    found = aligned(a, b, "ratio", "partial_ratio", "token_sort", "token_set")
    return {f"addr_{k}": found[k] for k in ("ratio", "partial_ratio", "token_sort", "token_set")} | {
        "addr_token_jaccard": token_jaccard(a, b),
        "addr_token_overlap": token_overlap(a, b),
        "addr_common_numbers": common_numbers(a, b),
        "addr_len_diff_ratio": length_difference(a, b),
        "addr_one_empty": one_empty(a, b),
    }


def all_similarities(name_a: Column, name_b: Column, address_a: Column, address_b: Column, country_a: Column, country_b: Column, use_country: bool = True) -> dict[str, Column]:
    """The twenty features by name, in the order of ``FEATURES``."""
    country = country_match(country_a, country_b) if use_country else F.lit(0.0)
    return name_similarities(name_a, name_b) | address_similarities(address_a, address_b) | {"country_match": country}
