"""Secret scans with a randomness test battery.

Every text is scanned whole for three fixed kinds (assign, access, hex) and for candidate
strings of 16 or more key characters. A run of key characters is split at '=' (less trailing padding), so that
a name and its value are apart; a part that fits one alphabet is a candidate as it is, and where it has '/', '+',
'_' or '-' so are its longest strings within base64 and within base64url, less words at their ends, and those between
the signs: a key at the end of a path is tested by itself. Of nested accepted candidates the longest is reported.

A candidate's encoding is inferred from its alphabet, and its symbols go
through three tests: chi-squared uniformity over that alphabet, a runs test on character
classes (small letters, capitals, digits, signs; vowels in one case of letters, halves in digits) and lag-1 serial correlation of the symbols' places in the
alphabet. Each test gives a p-value under "random"; a candidate that any of them rejects (Bonferroni,
``REJECT``) is out. Chi-squared and runs also give a p-value under "language-like", whose symbol
frequencies are uneven and whose classes change rarely
(vowels: often; digits have the first of the two only); the longer a string, the farther the two lie apart.
These are combined (Fisher) and go through the Benjamini-Hochberg procedure over the whole corpus,
separately for each encoding and length class, at rate ``FDR``: a histogram of p-values per class is summed in
Spark and gives one threshold each. Accepted candidates are added as kind ``random``, unless a base span covers them.

Spans are whole matches in code points, end exclusive. Defined results: a null text is empty: counts 0, the hash
of an empty string, no spans; repeated rows are scanned one by one; an empty table gives an empty result; further
columns are ignored.
"""
from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_with, kind_of, scratch_table

#: Fixed patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ["assign", "access", "hex", "random"]
_KEYWORD = ("passw", "secret", "token", "apikey", "api_key")

LEAST = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
VALUE = re.compile(r"[^=]+")
SIGNS = re.compile(r"[+/_-]")
BETWEEN = re.compile(r"[A-Za-z0-9]+")
WITHIN = [re.compile(r"[A-Za-z0-9+/]{%d,}" % LEAST), re.compile(r"[A-Za-z0-9_-]{%d,}" % LEAST)]
WORD = re.compile(r"[a-z]+|[A-Z][a-z]+|[A-Z]+|[0-9]+")
REJECT = 1e-3
FDR = 0.05
GRID = 20           # p-values are counted in steps of 10 ** (-1 / GRID)
TOP = 60 * GRID

#: Encodings by alphabet, smallest first.
ENCODINGS = {"decimal": "0123456789", "hex": "0123456789abcdef", "HEX": "0123456789ABCDEF",
             "lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
             "lower36": "0123456789abcdefghijklmnopqrstuvwxyz",
             "upper36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
             "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
             "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"}
_SETS = {k: frozenset(v) for k, v in ENCODINGS.items()}
_PLACE = {k: {c: i for i, c in enumerate(v)} for k, v in ENCODINGS.items()}
#: Sum of squared symbol frequencies in language-like strings (letters of European texts), and how often
#: the character class changes from one character to the next in joined words, numbers and identifiers.
LANGUAGE_COINCIDENCE, LANGUAGE_CHANGE = 0.066, 0.25
#: The same for vowels and other letters in words.
VOWEL_CHANGE = 0.6


def _phi(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _chi2_upper(x: float, df: int) -> float:
    """P(chi-squared >= x), Wilson-Hilferty."""
    return _phi(-((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))


def _kind(c: str) -> int:
    return 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3


#: The class of each symbol in the runs test.
_CLASS = {k: {c: int(c in "aeiouAEIOU") if k in ("lower", "upper") else int(c >= "5") if k == "decimal" else _kind(c)
              for c in v} for k, v in ENCODINGS.items()}


def infer_encoding(s: str) -> str | None:
    """The smallest alphabet that holds the string (less its padding), or none."""
    chars = set(s.rstrip("="))
    return next((name for name, have in _SETS.items() if chars <= have), None) if chars else None


def battery(s: str, encoding: str) -> tuple[float, float]:
    """(p under random, p under language-like) of a string's symbols."""
    s = s.rstrip("=")
    n, size, place = len(s), len(ENCODINGS[encoding]), _PLACE[encoding]
    v = np.array([place[c] for c in s], float)
    counts = np.bincount(v.astype(int), minlength=size)
    chi = float(((counts - n / size) ** 2).sum() * size / n)
    df = size - 1
    # few symbols per cell: match the variance of the exact multinomial statistic
    var = 2 * df * (n - 1) / n
    scaled = df + (chi - df) * math.sqrt(2 * df / max(var, 1e-9))
    p_chi = 2 * min(_chi2_upper(max(scaled, 1e-9), df), 1 - _chi2_upper(max(scaled, 1e-9), df))
    # under language the statistic is larger by n * (size * coincidence - 1)
    coincidence = max(LANGUAGE_COINCIDENCE, 1.6 / size)
    far = n * (size * coincidence - 1)
    q_chi = _phi((chi - (df + far)) / math.sqrt(2 * (df + 2 * far)))
    kinds = np.array([_CLASS[encoding][c] for c in s])
    change = int((kinds[1:] != kinds[:-1]).sum())
    share = np.bincount([_CLASS[encoding][c] for c in ENCODINGS[encoding]], minlength=4) / size
    rate = 1 - float((share**2).sum())
    m = n - 1
    sd = math.sqrt(m * rate * (1 - rate) * 1.2)
    p_runs = 2 * min(_phi((change + 0.5 - m * rate) / sd), _phi(-(change - 0.5 - m * rate) / sd))
    if encoding in ("lower", "upper"):
        r0 = VOWEL_CHANGE
        q_runs = _phi((change + 0.5 - m * r0) / math.sqrt(1.5 * m * r0 * (1 - r0)))
    else:
        r0 = LANGUAGE_CHANGE
        q_runs = _phi(-(change - 0.5 - m * r0) / math.sqrt(1.5 * m * r0 * (1 - r0)))
    d = v - v.mean()
    power = float((d * d).sum())
    r = float((d[1:] * d[:-1]).sum()) / power if power > 0 else 1.0
    p_serial = 2 * _phi(-abs(r + 1 / n) * math.sqrt(n))
    p_random = min(1.0, 3 * min(min(1.0, p_chi), min(1.0, p_runs), min(1.0, p_serial)))
    if encoding == "decimal":
        return p_random, q_chi
    x = -2 * (math.log(max(q_chi, 1e-300)) + math.log(max(q_runs, 1e-300)))
    return p_random, math.exp(-x / 2) * (1 + x / 2)        # Fisher: chi-squared with 4 degrees of freedom


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORD):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def _less_words(s: str, a: int, z: int) -> tuple[int, int]:
    """s[a:z] less the words before its first sign and after its last."""
    parts = [m.span() for m in BETWEEN.finditer(s, a, z)]
    i, j = 0, len(parts)
    while i < j and WORD.fullmatch(s, *parts[i]):
        i += 1
    while i < j and WORD.fullmatch(s, *parts[j - 1]):
        j -= 1
    if i == j:
        return a, a
    return a if i == 0 else parts[i][0], z if j == len(parts) else parts[j - 1][1]


def pieces(run: str) -> set[tuple[int, int]]:
    """(start, end) of the strings to test in a run of key characters."""
    end = len(run.rstrip("="))
    out = set()
    for m in VALUE.finditer(run, 0, end):
        a, z = m.span()
        found = {(a, z)} if infer_encoding(m[0]) else set()
        if SIGNS.search(run, a, z):
            found.update(_less_words(run, *x.span()) for form in WITHIN for x in form.finditer(run, a, z))
            found.update(x.span() for x in BETWEEN.finditer(run, a, z))
        out |= {(x, len(run) if y == end else y) for x, y in found}     # the last one with its padding
    return {(x, y) for x, y in out if y - x >= LEAST}


def candidates(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, encoding, p under language-like) of the strings that pass as random. All candidates
    that the battery does not rule out as random are in, also those that a base span covers: the
    false-discovery procedure counts them too."""
    out = []
    for m in CANDIDATE.finditer(text):
        for a, z in sorted(pieces(m[0])):
            piece = m[0][a:z]
            encoding = infer_encoding(piece)
            if encoding is None or len(piece.rstrip("=")) < 2:
                continue
            p_random, p_language = battery(piece, encoding)
            out.append((m.start() + a, m.start() + z, encoding, p_language if p_random >= REJECT else 1.0))
    return out


def outermost(spans, own) -> list[tuple[str, int, int]]:
    """Of spans (kind, start, end) those inside no other one and no span of ``own``."""
    out, reach, own, at, covered = [], -1, sorted(own, key=lambda x: x[1]), 0, -1
    for k, a, z in sorted(spans, key=lambda x: (x[1], -x[2])):
        while at < len(own) and own[at][1] <= a:             # the farthest end of those that start here or before
            covered, at = max(covered, own[at][2]), at + 1
        if z > reach and z > covered:
            out.append((k, a, z))
            reach = z
    return out


def length_class(n: int) -> int:
    return int(2 * math.log2(n))


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base (spans joined), counts, and the candidates as parallel arrays."""
    def run(batches):
        for b in batches:
            cols = {k: [] for k in ("base", "n_assign", "n_access", "n_hex", "starts", "ends", "classes", "steps")}
            for t in b.column("text"):
                text = t.as_py() or ""
                base = base_spans(text)
                found = candidates(text)
                cols["base"].append(joined(base))
                for k in KINDS[:3]:
                    cols["n_" + k].append(sum(x[0] == k for x in base))
                cols["starts"].append([x[0] for x in found])
                cols["ends"].append([x[1] for x in found])
                cols["classes"].append([f"{x[2]}:{length_class(x[1] - x[0])}" for x in found])
                cols["steps"].append([min(TOP, int(-math.log10(max(x[3], 1e-60)) * GRID)) for x in found])
            kinds = {"base": pa.string(), "classes": pa.list_(pa.string()), "starts": pa.list_(pa.int64()),
                     "ends": pa.list_(pa.int64()), "steps": pa.list_(pa.int32())}
            yield batch_with(b, ["doc_id"], **{k: pa.array(v, kinds.get(k, pa.int64())) for k, v in cols.items()})

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind_of(docs, 'doc_id')}, base string, n_assign bigint, n_access bigint, n_hex bigint, "
             "starts array<bigint>, ends array<bigint>, classes array<string>, steps array<int>")


def thresholds(scanned: DataFrame, rate: float = FDR) -> dict[str, int]:
    """Benjamini-Hochberg per class: the least step whose p-value is at most rate * rank / tests. At most
    TOP + 1 counts a class, and a few dozen classes (11 encodings times twice the log of the length)."""
    tests = scanned.select(F.explode(F.arrays_zip("classes", "steps")).alias("x")).select("x.classes", "x.steps")
    hist = tests.groupBy("classes", "steps").agg(F.count(F.lit(1)).alias("n"))
    better = Window.partitionBy("classes").orderBy(F.col("steps").desc())
    hist = (hist.withColumn("rank", F.sum("n").over(better))
            .withColumn("tests", F.sum("n").over(Window.partitionBy("classes"))))
    p = F.pow(F.lit(10.0), -F.col("steps") / F.lit(float(GRID)))
    ok = hist.filter(p <= rate * F.col("rank") / F.col("tests"))
    return {r["classes"]: r["least"] for r in ok.groupBy("classes").agg(F.min("steps").alias("least")).collect()}


def _parse(base: str) -> list[tuple[str, int, int]]:
    return [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in base.split(","))] if base else []


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (base ones and accepted candidates), n_random."""
    scanned = scratch_table(scan(docs), "candidates")
    cut = scanned.sparkSession.sparkContext.broadcast(thresholds(scanned))

    def run(batches):
        for b in batches:
            digests, spans, added = [], [], []
            for base, starts, ends, classes, steps in zip(*(b.column(c).to_pylist() for c in (
                    "base", "starts", "ends", "classes", "steps"))):
                own = _parse(base)
                more = outermost([("random", a, z) for a, z, c, s in zip(starts, ends, classes, steps)
                                  if s >= cut.value.get(c, TOP + 1)], own)
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                spans.append(joined(own + more))
                added.append(len(more))
            yield batch_with(b, ["doc_id", "n_assign", "n_access", "n_hex"], base_sha256=pa.array(digests, pa.string()),
                             spans=pa.array(spans, pa.string()), n_random=pa.array(added, pa.int64()))

    return scanned.mapInArrow(run, f"doc_id {kind_of(docs, 'doc_id')}, n_assign bigint, n_access bigint, n_hex bigint, "
                                   "base_sha256 string, spans string, n_random bigint")
