"""Secret scans: fixed patterns, and a battery of randomness tests on runs that look encoded.

A run of an encoding's characters, or what base matches leave of it, is a candidate, and so are its pieces between
each choice of the separators it holds, for a token may be joined to ordinary text. A candidate's encoding is inferred: the smallest alphabet that holds it
(hexadecimal, base32, base36, base58, base62, base64, in either case; a run without a digit, which few random strings
are, is taken as letters, and with them base64's signs). A random string that lies in a smaller alphabet by chance is
random there too. Its characters become numbers, and four tests ask whether they were drawn at random:
chi-squared against uniform use of the alphabet, runs above and below its middle, serial correlation, and how
common its letters are in words. Fisher's method joins their p-values into one, uniform for random strings and
near zero for others.

How well the battery tells the two apart depends on the length, so findings are cut for each encoding and
length class by itself: random strings show as the even part of the class's p-values, which tells how many
of the candidates above a cut are not random, and the lowest cut with a share of at most FALSE_SHARE is taken.
The counts this needs are a table of classes by bins, as large for any corpus, from all candidates. A class of
few candidates says little about itself. So each class is joined by PRIOR candidates that lie as those of its encoding do, with
PRIOR random strings among them, and by DOUBT that are not random in its lowest bins. Their weight falls as the class
grows, without a step. So random strings alone in a class are kept but for the lowest bins, however small the corpus,
and ordinary ones are not if their encoding shows many.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from surveymill.llm.common import arrow_schema, per_text, stage

# Kinds in their order, the base patterns, and the lengths that matches must have.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
_KEYWORDS = ("passw", "secret", "token", "api")

MIN_RANDOM = 20
_RUN = re.compile(rf"[A-Za-z0-9+/_-]{{{MIN_RANDOM},}}")
_DIGIT = re.compile("[0-9]")
SEPARATORS = "/-_+"
_PIECES = {
    chosen: re.compile(f"[^{re.escape(''.join(chosen))}]{{{MIN_RANDOM},}}")
    for n in range(1, len(SEPARATORS) + 1) for chosen in combinations(SEPARATORS, n)
}
# The alphabets in the order of their values; base64 also in its form for addresses.
_HEX, _UPPER_HEX = "0123456789abcdef", "0123456789ABCDEF"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE36 = "0123456789abcdefghijklmnopqrstuvwxyz"
_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_VALUES = {name: {c: v for v, c in enumerate(text)} for name, text in (
    ("hex", _HEX), ("upper_hex", _UPPER_HEX), ("base32", _BASE32), ("base36", _BASE36), ("base64", _BASE64)
)}
_VALUES["base64"] |= {"-": 62, "_": 63}
# Alphabets that leave out a few characters of a larger one, so that only long runs tell them apart,
# and those of runs without a digit. Smallest first.
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CROCKFORD = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
_LONG = {name: {c: v for v, c in enumerate(text)} for name, text in (
    ("hex", _HEX), ("upper_hex", _UPPER_HEX), ("base32", _BASE32), ("lower_base32", _BASE32.lower()),
    ("base32hex", _BASE36[:32].upper()), ("lower_base32hex", _BASE36[:32]),
    ("crockford", _CROCKFORD), ("lower_crockford", _CROCKFORD.lower()), ("base36", _BASE36), ("upper_base36", _BASE36.upper()),
    ("base58", "".join(c for c in _BASE64[:62] if c not in "0OIl")), ("base62", _BASE64[:62]),
)}
_LETTERS = {name: {c: v for v, c in enumerate(text)} for name, text in (
    ("lower", _LOWER), ("upper", _UPPER), ("letters", _UPPER + _LOWER), ("letters_signs", _UPPER + _LOWER + "+/")
)}
_LETTERS["letters_signs"] |= {"-": 52, "_": 53}
_TABLES = _VALUES | _LONG | _LETTERS
# Letters from the commonest to the rarest in words; other characters weigh nothing.
_COMMON = "etaoinsrhldcumfpgwybvkxjqz"
_WEIGHTS = {c: 12.5 - v for v, c in enumerate(_COMMON)}
_WEIGHTS |= {c.upper(): w for c, w in _WEIGHTS.items()}

AROUND = 0.001  # the least p-value of a candidate around one that is kept
LENGTH_CLASSES = (24, 28, 32, 40, 48, 64, 128)  # upper ends, the last class is open
BINS = 50
FALSE_SHARE = 0.05
SHARES = tuple(FALSE_SHARE * n / 20 for n in range(10, 31))
PRIOR, DOUBT = 100, 40  # candidates that join a class: as its encoding has them, and in the lowest bins
BOUND, LETTERS_BOUND = 1, 5  # the lowest bins, which a class must show to be random; runs without a digit are words more often

_FOUND = "base array<struct<start:int,kind:int,end:int>>, candidates array<struct<start:int,end:int,class:string,p:double>>"


def chi_squared_tail(x: float, dof: int) -> float:
    """P(chi-squared with ``dof`` degrees of freedom > x)."""
    half = x / 2
    if half > 700:
        return 0.0
    if dof % 2 == 0:
        term, total = 1.0, 1.0
        for i in range(1, dof // 2):
            term *= half / i
            total += term
        return min(1.0, math.exp(-half) * total)
    total, term = 0.0, math.sqrt(half) / math.gamma(1.5)
    for i in range(1, (dof - 1) // 2 + 1):
        total += term
        term *= half / (i + 0.5)
    return min(1.0, math.erfc(math.sqrt(half)) + math.exp(-half) * total)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _above(z: float) -> float:
    return math.erfc(z / math.sqrt(2)) / 2


def uniformity(values: list[int], size: int) -> float:
    """p of chi-squared against even use of the alphabet, in as many groups as leave four characters to each."""
    n = len(values)
    groups = max(2, min(size, n // 4))
    counts = [0] * groups
    for v in values:
        counts[v * groups // size] += 1
    share = [0] * groups
    for v in range(size):
        share[v * groups // size] += 1
    return chi_squared_tail(sum((c - n * s / size) ** 2 / (n * s / size) for c, s in zip(counts, share, strict=True)), groups - 1)


def runs(values: list[int], size: int) -> float:
    """p of the number of runs above and below the alphabet's middle."""
    high = [2 * v >= size for v in values]
    n, n1 = len(high), sum(high)
    n2 = n - n1
    if not n1 or not n2:
        return min(1.0, 2.0 ** (1 - n))
    count = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    mean = 2 * n1 * n2 / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return _two_sided((count - mean) / math.sqrt(variance)) if variance > 0 else 1.0


def serial(values: list[int], size: int) -> float:
    """p of the correlation of neighbours."""
    mean, variance = (size - 1) / 2, (size * size - 1) / 12
    n = len(values) - 1
    total = sum((a - mean) * (b - mean) for a, b in zip(values, values[1:], strict=False))
    return _two_sided(total / (variance * math.sqrt(n)))


@cache
def _expected(encoding: str) -> tuple[int, float, float]:
    """The size of an alphabet, and mean and variance of its letters' weights."""
    table = _TABLES[encoding]
    size = max(table.values()) + 1
    weights = [_WEIGHTS.get(c, 0.0) for c in list(table)[:size]]
    mean = sum(weights) / size
    return size, mean, sum((w - mean) ** 2 for w in weights) / size


def commonness(run: str, encoding: str) -> float:
    """p of the letters' weights: words use common letters more."""
    _, mean, variance = _expected(encoding)
    return _above((sum(_WEIGHTS.get(c, 0.0) for c in run) - len(run) * mean) / math.sqrt(variance * len(run)))


def infer(run: str) -> str | None:
    """The smallest encoding that holds the run; None without a digit. See inferred() for those."""
    if not _DIGIT.search(run):
        return None
    chars = set(run)
    if len(run) >= MIN_RANDOM and (found := next((name for name, values in _LONG.items() if chars <= values.keys()), None)):
        return found
    return next((name for name, values in _VALUES.items() if chars <= values.keys()), None)


def inferred(run: str) -> str:
    """The smallest encoding that holds a candidate, with a digit or without."""
    chars = set(run)
    return infer(run) or next(name for name, values in _LETTERS.items() if chars <= values.keys())


def randomness(run: str, encoding: str) -> float:
    """The battery's joint p-value for a run."""
    table = _TABLES[encoding]
    size = _expected(encoding)[0]
    values = [table[c] for c in run]
    found = [*(test(values, size) for test in (uniformity, runs, serial)), commonness(run, encoding)]
    ps = [max(p, 1e-300) for p in found]
    return chi_squared_tail(-2 * sum(map(math.log, ps)), 2 * len(ps))


def length_class(n: int) -> int:
    return sum(n > end for end in LENGTH_CLASSES)


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans in order, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def outside(found: Iterable[tuple[int, int]], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What spans in order, merged as well, leave of runs in order, where it is long enough."""
    at = 0
    for start, end in found:
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        i = at
        while i < len(taken) and taken[i][0] < end:
            if taken[i][0] - start >= MIN_RANDOM:
                yield start, taken[i][0]
            start = taken[i][1]
            i += 1
        if end - start >= MIN_RANDOM:
            yield start, end


def pieces(run: str) -> list[tuple[int, int]]:
    """The run and its long enough pieces between separators of each choice of them, from left to right."""
    present = [c for c in SEPARATORS if c in run]
    found = {(0, len(run))}
    for n in range(1, len(present) + 1):
        for chosen in combinations(present, n):
            found.update(m.span() for m in _PIECES[chosen].finditer(run))
    return sorted(found, key=lambda span: (span[0], -span[1]))


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, str, float]]]:
    """Base matches ``(start, kind, end)`` in order, and candidates ``(start, end, class, p)`` outside of them.

    Candidates may overlap: a run and its pieces.
    """
    base = []
    lowered = text.lower()
    if any(word in lowered for word in _KEYWORDS):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    found = []
    for m in _RUN.finditer(text):  # the other base matches that are long enough lie within such runs
        start, run = m.start(), m[0]
        found.append(m.span())
        base += [(start + x.start(), 1, start + x.end()) for x in ACCESS.finditer(run) if len(x[0]) >= MIN_ACCESS]
        base += [(start + x.start(), 2, start + x.end()) for x in HEX.finditer(run) if len(x[0]) >= MIN_HEX]
    base.sort()
    candidates = []
    for start, end in outside(found, merged((a, b) for a, _, b in base)):
        for a, b in pieces(text[start:end]):
            piece = text[start + a : start + b]
            encoding = inferred(piece)
            candidates.append((start + a, start + b, f"{encoding}:{length_class(b - a)}", randomness(piece, encoding)))
    return base, candidates


def _scan_all(texts: list[str]) -> dict[str, list]:
    found = [scan(text) for text in texts]
    return {
        "base": [[dict(zip(("start", "kind", "end"), x, strict=True)) for x in base] for base, _ in found],
        "candidates": [[dict(zip(("start", "end", "class", "p"), x, strict=True)) for x in rest] for _, rest in found],
    }


def cut(bins: list[int] | list[float]) -> float:
    """The lowest p-value kept in a class, from its counts by bin of the p-value (the last bin ends at 1).

    It is the mean over shares of false findings around FALSE_SHARE, so that one candidate does not move it far where
    many bins are near the share. 2 if no bin has so few.
    """
    size, above, sums = len(bins), 0.0, []
    for count in reversed(bins):
        above += count
        sums.append(above)
    random = min(above, 2 * sums[size - size // 2 - 1])  # random strings fill all bins alike; the upper half shows them best
    lowest = [size] * len(SHARES)
    for first in range(size):
        above = sums[size - 1 - first]
        false = above - random * (size - first) / size
        for i, share in enumerate(SHARES):
            if above and false <= share * above:
                lowest[i] = min(lowest[i], first)
    return 2.0 if min(lowest) == size else sum(lowest) / len(lowest) / size


def class_cuts(bins: dict[str, list[int]]) -> dict[str, float]:
    """The cut of each class, from the counts of all; the fewer a class has, the more it leans on its encoding."""
    of_encodings: dict[str, list[float]] = {}
    for name, counts in bins.items():
        total = of_encodings.setdefault(name.partition(":")[0], [PRIOR / BINS] * BINS)
        for i, count in enumerate(counts):
            total[i] += count
    lowest = {}
    for name, counts in bins.items():
        encoding = name.partition(":")[0]
        bound = LETTERS_BOUND if encoding in _LETTERS else BOUND
        like = of_encodings[encoding]
        weight = PRIOR / sum(like[bound:])
        lowest[name] = cut([n + (DOUBT / bound if i < bound else weight * x) for i, (n, x) in enumerate(zip(counts, like, strict=True))])
    return lowest


def cuts(found: DataFrame) -> dict[str, float]:
    """The cut of each encoding and length class, from all candidates."""
    one = found.select(F.explode("candidates").alias("c"))
    binned = one.select(F.col("c.class").alias("class"), F.least(F.lit(BINS - 1), F.floor(F.col("c.p") * BINS)).alias("bin"))
    bins: dict[str, list[int]] = {}
    for row in binned.groupBy("class", "bin").agg(F.count("*").alias("n")).collect():  # classes x bins at most
        bins.setdefault(row["class"], [0] * BINS)[row["bin"]] = row["n"]
    return class_cuts(bins)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, base, candidates)`` of every row, staged: the texts are read once."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return stage(per_text(rows, ["doc_id"], "text", _scan_all, _FOUND), "secrets")


def accepted(candidates: Iterable[tuple[int, int, str, float]], lowest: dict[str, float]) -> list[tuple[int, int]]:
    """The candidates that their class's cut keeps, without overlap.

    Where a piece is kept, so are those around it that may well be random, so that no part of a token is left.
    """
    candidates = list(candidates)
    kept = merged((a, b) for a, b, name, p in candidates if p >= lowest.get(name, 2.0))
    starts, around = [a for a, _ in kept], []
    for a, b, _, p in candidates if kept else []:
        i = bisect_left(starts, a)
        if p >= AROUND and i < len(kept) and kept[i][1] <= b:
            around.append((a, b))
    return merged(kept + around)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, spans)`` of every row: structs (start, kind, end) by start, then kind; code points, end exclusive.

    Kinds are numbers into KINDS. Defined cases: a null or empty text has no spans; rows without id, or that
    repeat one, have a row each; an empty table has none; other columns are not read.
    """
    found = scan_documents(docs, id_col, text_col)
    lowest, kind = cuts(found), KINDS.index("random")
    added = "random array<struct<start:int,kind:int,end:int>>"
    schema = StructType([*found.select("doc_id", "base").schema.fields, *_parse_datatype_string(added).fields])
    spans_type = arrow_schema(added).field(0).type

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ([tuple(c.values()) for c in row] for row in batch.column(2).to_pylist())
            spans = [[{"start": a, "kind": kind, "end": b} for a, b in accepted(row, lowest)] for row in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, spans_type)], ["doc_id", "base", "random"])

    kept = found.select("doc_id", "base", "candidates").mapInArrow(keep, schema)
    return kept.select("doc_id", F.array_sort(F.concat("base", "random")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, with every secret in the text replaced by ``mark``; a null text stays null.

    Rows are neither moved nor joined: the cuts are learned from a first scan of all texts.
    """
    names = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index(text_col)}"
    lowest = cuts(per_text(numbered.select(text), [], text, _scan_all, _FOUND))

    def work(texts: list[str]) -> dict[str, list]:
        return {"cleaned": [replace_spans(t, mark, lowest) for t in texts]}

    cleaned = per_text(numbered, numbered.columns, text, work, "cleaned string")
    kept = F.when(F.col(text).isNull(), F.col(text)).otherwise(F.col("cleaned"))
    return cleaned.select(*[(kept if f"c{i}" == text else F.col(f"c{i}")).alias(n) for i, n in enumerate(names)])


def replace_spans(text: str, mark: str, lowest: dict[str, float]) -> str:
    """The text with its secrets replaced; spans that overlap become one mark."""
    base, candidates = scan(text)
    spans = [(a, b) for a, _, b in base] + accepted(candidates, lowest)
    out, at = [], 0
    end = -1
    for start, stop in sorted(spans):
        if start >= end:
            out += [text[at:start], mark]
        end = max(end, stop)
        at = end
    return "".join(out) + text[at:]
