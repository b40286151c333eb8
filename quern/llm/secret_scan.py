"""Secret scans (operator 7): three fixed patterns, and a battery of randomness tests for what they miss.

Base spans (code points, end exclusive; the span is the whole match) are the leftmost, non-overlapping matches by kind.
Other runs of `[A-Za-z0-9+/_=-]` are cut at base spans and at `=` inside (padding stays with the part before it); parts of
at least `least` characters are candidates. The encoding is the narrowest alphabet that holds the part's symbols (hex in one
case, base 32, base 36 in one case, base 62, base 64); decimal parts and those that no alphabet holds are no candidates. Each
candidate takes tests of its symbols: chi-squared against a uniform alphabet, number of runs above and below the alphabet's
middle, and lag-1 serial correlation; it passes for random where none of the three is below `passing`. Its p-value is the chance
that ordinary text gives so low a chi-squared, or 1 where it doesn't pass. Both chi-squared tests are exact, as the expected
counts are small: at a given length chi-squared says the same as the number of equal pairs of symbols, whose distribution
follows from the shares of the symbols (even ones, or those of letters and digits in text). Runs of more than `BLOCK` symbols are cut into blocks of
about equal size, whose p-values Fisher's method combines. All candidates of all documents count, whether they pass or
not: among those in the same class of lengths, the Benjamini-Hochberg rule at `rate` on a grid of p-values (tenths of a power
of ten, rounded up) decides which are added, as kind "random".

Null texts read as empty; empty texts have no spans; rows with null or repeated ids are rows of their own and count in the
rule as often as they occur. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import written

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = r"[A-Za-z0-9+/_=-]"
PART = re.compile(r"[^=]+(?:=+(?![A-Za-z0-9+/_-]))?")
KINDS = ("assign", "access", "hex", "random")
#: Encodings from narrow to wide, by the pattern that the symbols fit; padding is no symbol.
ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
#: Shares of the letters a to z in ordinary text, in thousandths; of all digits and all signs together, and of capitals among letters.
LETTERS = dict(zip("abcdefghijklmnopqrstuvwxyz", (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1), strict=True))
DIGITS, SIGNS, CAPITALS = 0.1, 0.02, 0.15
#: Lengths from which a class begins.
CLASSES = (20, 28, 40, 64)
#: p-values below 10**-(STEPS / 10) count as that.
STEPS = 200
#: Most symbols, and most equal pairs, that the exact tests reckon with.
BLOCK, PAIRS = 64, 240


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), in order; kind is an index of KINDS."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20] if "AKIA" in text else []
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def encoding(run: str, bare: bool = False) -> str | None:
    """The narrowest alphabet of a run without padding; None where it has none, is decimal or, unless `bare`, has no digit."""
    held = set(run)
    if held <= set("0123456789") or not (bare or any(c.isdigit() for c in held)):
        return None
    return next((alphabet for _, alphabet in ALPHABETS if held <= set(alphabet)), None)


def shares_in_text(alphabet: str) -> list[float]:
    """The share of each symbol of an alphabet in ordinary text that has no others."""
    held = set(alphabet)
    digits, signs = sum(c.isdigit() for c in held), sum(not c.isalnum() for c in held)

    def share(c: str) -> float:
        if c.isdigit():
            return DIGITS / 10
        if not c.isalnum():
            return SIGNS / signs
        both = c.swapcase() in held
        return LETTERS[c.lower()] / 1000 * (1 - DIGITS * (digits > 0) - SIGNS * (signs > 0)) * ((CAPITALS if c.isupper() else 1 - CAPITALS) if both else 1)

    shares = [share(c) for c in alphabet]
    return [p / sum(shares) for p in shares]


@cache
def pairs_at_most(alphabet: str, text: bool) -> np.ndarray:
    """[n, c]: the chance that n symbols, independent and with the shares of text or even ones, have at most c equal pairs."""
    at = np.zeros((BLOCK + 1, PAIRS + 1))
    at[0, 0] = 1.0
    for p in shares_in_text(alphabet) if text else [1 / len(alphabet)] * len(alphabet):
        before, term = at, 1.0
        at = before.copy()
        for times in range(1, BLOCK + 1):
            pairs, term = times * (times - 1) // 2, term * p / times
            if pairs > PAIRS:
                break
            at[times:, pairs:] += term * before[: BLOCK + 1 - times, : PAIRS + 1 - pairs]
    ways = np.cumprod(np.concatenate(([1.0], np.arange(1, BLOCK + 1, dtype=float))))
    return np.minimum(np.cumsum(at * ways[:, None], axis=1), 1.0)


def combined(ps: list[float]) -> float:
    """Fisher's method: the chance of so low a product of p-values of independent tests."""
    if len(ps) == 1 or min(ps) <= 0:
        return min(ps)
    half = -sum(map(math.log, ps))
    logs = [i * math.log(half) - math.lgamma(i + 1) if half else -math.inf * (i > 0) for i in range(len(ps))]
    top = max(logs)
    return min(1.0, math.exp(top - half) * sum(math.exp(x - top) for x in logs))


def battery(run: str, alphabet: str) -> dict[str, float]:
    """p-values: of the three tests for random (small: not random) and of `text` (small: too even for text)."""
    n, a = len(run), len(alphabet)
    place = {c: i for i, c in enumerate(alphabet)}
    at = np.array([place[c] for c in run], dtype=float)
    edges = np.linspace(0, n, -(-n // BLOCK) + 1).astype(int)
    uniform, text = [], []
    for start, end in zip(edges, edges[1:], strict=False):
        counts = np.bincount(at[start:end].astype(int), minlength=a)
        pairs = int((counts * (counts - 1) // 2).sum())
        even, plain = pairs_at_most(alphabet, False)[end - start], pairs_at_most(alphabet, True)[end - start]
        uniform.append(0.0 if pairs > PAIRS else 1.0 if not pairs else max(1 - even[pairs - 1], 0.0))
        text.append(1.0 if pairs > PAIRS else float(plain[pairs]))
    high = at >= a / 2
    n1, n0 = int(high.sum()), int(n - high.sum())
    p_runs = 0.0
    if n1 and n0 and n > 2:
        runs, mean = 1 + int((high[1:] != high[:-1]).sum()), 1 + 2 * n1 * n0 / n
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        p_runs = math.erfc(abs(runs - mean) / spread / math.sqrt(2))
    centred = at - at.mean()
    total = float((centred**2).sum())
    serial = float((centred[1:] * centred[:-1]).sum()) / total if total else 1.0
    p_serial = math.erfc(abs(serial + 1 / n) * math.sqrt(n) / math.sqrt(2))
    return {"uniform": combined(uniform), "runs": p_runs, "serial": p_serial, "text": combined(text)}


def joined(base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What base spans, sorted by start, cover."""
    out: list[tuple[int, int]] = []
    for a, _, b in base:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def parts(start: int, end: int, text: str, covered: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What covered stretches and inner `=` leave of the run text[start:end]; padding belongs to the part before it."""
    free, at = [], start
    for k in range(bisect_right(covered, start, key=lambda c: c[1]), len(covered)):
        a, b = covered[k]
        if a >= end:
            break
        free.append((at, a))
        at = b
    for a, b in (*free, (at, end)):
        for m in PART.finditer(text, a, max(a, b)):
            yield m.span()


def candidates(text: str, base: list[tuple[int, int, int]], find: re.Pattern, passing: float) -> list[dict]:
    """Parts of runs that an alphabet holds: start, end, class of length and step of their p-value (0 where they don't pass)."""
    out, covered = [], joined(base)
    for start, end in (p for m in find.finditer(text) for p in parts(m.start(), m.end(), text, covered)):
        run = text[start:end].rstrip("=")
        if len(run) < CLASSES[0] or not find.fullmatch(text, start, end) or (alphabet := encoding(run, bare=True)) is None:
            continue
        got = battery(run, alphabet)
        p = got["text"] if min(got["uniform"], got["runs"], got["serial"]) >= passing else 1.0
        step = min(STEPS, int(-10 * math.log10(p))) if p > 0 else STEPS
        out.append({"start": start, "end": end, "size": sum(len(run) >= c for c in CLASSES), "step": step})
    return out


def _scan(batches: Iterator[pa.RecordBatch], least: int, passing: float) -> Iterator[pa.RecordBatch]:
    find = re.compile(f"{RUN}{{{least},}}")
    spans = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    runs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("size", pa.int32()), ("step", pa.int32())]))
    for batch in batches:
        base, more = [], []
        for x in batch.column("text"):
            text = x.as_py() or ""
            got = base_spans(text)
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in got])
            more.append(candidates(text, got, find, passing))
        yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "base": pa.array(base, spans), "runs": pa.array(more, runs)})


def limits(found: DataFrame, rate: float) -> DataFrame:
    """By class of length, the least step that the Benjamini-Hochberg rule lets in; at most STEPS + 1 rows a class are ranked."""
    grid = found.select(F.explode("runs").alias("r")).groupBy("r.size", "r.step").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("size")
    let = F.pow(F.lit(10.0), -F.col("step") / 10) * F.sum("n").over(by) <= rate * F.sum("n").over(by.orderBy(F.col("step").desc()))
    return grid.withColumn("let", let).filter("let").groupBy("size").agg(F.min("step").alias("step"))


def printed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = 20, passing: float = 0.001, rate: float = 0.01) -> DataFrame:
    """One row per document: id, counts of the base kinds, base_sha256, spans and n_random. Text is read once; what it
    gave is written to the shared folder, as the rule needs the candidates of all documents first."""
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    spans, runs = "array<struct<start:int,kind:int,end:int>>", "array<struct<start:int,end:int,size:int,step:int>>"
    schema = texts.select("id", F.lit(None).cast(spans).alias("base"), F.lit(None).cast(runs).alias("runs")).schema
    found = written(texts.mapInArrow(lambda b: _scan(b, least, passing), schema), "secrets")
    let = {r["size"]: r["step"] for r in limits(found, rate).collect()}  # a row for each class of lengths
    kept = F.filter("runs", lambda r: r["step"] >= F.element_at(F.array(*[F.lit(let.get(k + 1, STEPS + 1)) for k in range(len(CLASSES))]), r["size"]))
    added = F.transform(kept, lambda r: F.struct(r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end")))

    def n_of(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("id").alias(id_col),
        n_of(0).alias("n_assign"),
        n_of(1).alias("n_access"),
        n_of(2).alias("n_hex"),
        F.sha2(printed(F.col("base")), 256).alias("base_sha256"),
        printed(F.concat("base", added)).alias("spans"),
        F.size(kept).cast("long").alias("n_random"),
    )
