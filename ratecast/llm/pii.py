"""PII by weak supervision.

Whole texts are scanned for four fixed kinds (email, ip, card, phone) and for looser candidates: what
nearly fits the fixed kinds, spelled-out e-mail addresses, national phone numbers, social security numbers,
IBANs and names. Six labelers vote 1, -1 or 0 on each candidate: form (regex), check digits and ranges,
gazetteer, context cues for, context cues against, and how the span is set off from its
neighbours. Expectation-maximisation (a Dawid-Skene model with one prior per kind) estimates how reliable each
labeler is from the counts of vote patterns, which Spark sums; its posteriors train a logistic span classifier on
at most ``TRAIN_SPANS`` candidates. Candidates the classifier accepts are added unless they
overlap a span already taken; base spans always stay.

Spans are in code points, end exclusive. Defined results: a null text is empty: counts 0, the hash of an empty
string, no spans; repeated rows are scanned one by one; an empty table gives an empty
result; without candidates nothing is trained; further columns are ignored.
"""
from __future__ import annotations

import bisect
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_with, first_by_hash, kind_of, scratch_table

TRAIN_SPANS = 50_000
ACCEPT = 0.9
KINDS = ["email", "ip", "card", "phone", "ssn", "iban", "name"]
LABELERS = ["form", "check", "gazetteer", "cue", "anti_cue", "set_off"]

#: Fixed patterns. The e-mail pattern is applied from its @ sign backwards, and a number starts at the start of
#: a run of digits: the same matches, without trying every start of a long run.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_SPELLED = re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?[\[(]dot[\])] ?[A-Za-z]{2,}+)+")
_NATIONAL = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9-])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")

#: Gazetteers and cues: fixed words.
_NAMES = ("James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph "
          "Thomas Charles Karen Daniel Nancy Anna Peter Paul Laura Marie Pierre Jean Claire Hans Klaus Ursula Petra "
          "Carlos Maria Jose Carmen Luis Ana Juan Sofia").split()
_TLDS = frozenset("com org net edu gov io info biz de fr es it uk eu us ca ch at nl be pl se no dk fi pt example test".split())
_CUES = {"email": "mail contact write reply", "ip": "ip address host server login", "card": "card visa mastercard credit payment",
         "phone": "phone tel call mobile fax contact cell", "ssn": "ssn social security", "iban": "iban account bank",
         "name": "mr mrs ms dr name dear signed author"}
_ANTI = "version build isbn invoice order sku ticket page section chapter model serial part ref revision".split()
_WORD = re.compile(r"[a-z]+")
_NAME = re.compile(r"\b(?:%s) [A-Z][a-z]++\b" % "|".join(_NAMES))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str):
    at, end = text.find("@"), 0
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            a = at
            while a > end and text[a - 1] in _LOCAL:
                a -= 1
            if a < at:
                yield a, m.end()
                end = m.end()
        at = text.find("@", at + 1)


def _parts_ok(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _card_ok(s: str) -> bool:
    d = _digits(s)
    return 16 <= len(d) <= 19 and luhn(d)


def _phone_ok(s: str) -> bool:
    return 8 <= len(_digits(s)) <= 15


def find(text: str):
    """((kind, start, end) base spans, (kind, start, end) further candidates) of a whole text."""
    base, more = [], []
    if "@" in text:
        base += [("email", a, b) for a, b in emails(text)]
    if re.search(r"[0-9]", text):
        for kind, pattern, ok in (("ip", IP, _parts_ok), ("card", CARD, _card_ok), ("phone", PHONE, _phone_ok)):
            if kind == "phone" and "+" not in text:
                continue
            for m in pattern.finditer(text):
                if ok(m[0]):
                    base.append((kind, *m.span()))
                elif kind != "card" or 12 <= len(_digits(m[0])) <= 19:
                    more.append((kind, *m.span()))
        for kind, pattern in (("phone", _NATIONAL), ("ssn", _SSN), ("iban", _IBAN)):
            more += [(kind, *m.span()) for m in pattern.finditer(text)]
    if "at]" in text or "at)" in text:
        more += [("email", *m.span()) for m in _SPELLED.finditer(text)]
    more += [("name", *m.span()) for m in _NAME.finditer(text)]
    return base, more


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def votes(text: str, kind: str, a: int, b: int, is_base: bool) -> list[int]:
    s = text[a:b]
    digits = _digits(s)
    form = 1 if is_base else -1 if kind in ("ip", "card") or s.startswith("+") else 0
    check = {"card": lambda: 1 if luhn(digits) else -1, "iban": lambda: 1 if _iban_ok(s) else -1,
             "ip": lambda: 1 if _parts_ok(s) and s.split(".")[0].lstrip("0") not in ("", "127", "255") else -1,
             "ssn": lambda: -1 if s[:3] in ("000", "666") or s[0] == "9" or s[4:6] == "00" or s[7:] == "0000" else 1,
             "phone": lambda: 1 if 8 <= len(digits) <= 15 else -1}.get(kind, lambda: 0)()
    if kind == "email":
        gaz = 1 if re.split(r"[^A-Za-z0-9-]+", s.rstrip(")]"))[-1].lower() in _TLDS else -1
    elif kind == "card":
        gaz = 1 if digits[:1] in "3456" else -1
    elif kind == "phone":
        gaz = 1 if len(set(digits)) > 2 else -1
    else:
        gaz = 1 if kind == "name" else 0
    near = _WORD.findall(text[max(0, a - 48):a].lower())[-5:]
    cue = 1 if any(w in _CUES[kind].split() for w in near) else 0
    anti = -1 if any(w in _ANTI for w in near[-3:]) else 0
    before, after = text[a - 1:a] if a else " ", text[b:b + 1] or " "
    set_off = -1 if before.isalnum() or after.isalnum() or before in "=/_" else 1 if before in " \n\t(<[:" else 0
    return [form, check, gaz, cue, anti, set_off]


def _features(kind: np.ndarray, vote: np.ndarray, length: np.ndarray, digits: np.ndarray) -> np.ndarray:
    """Span features for the classifier: kind, votes for and against, length and digit share."""
    one = np.eye(len(KINDS))[kind]
    share = digits / np.maximum(length, 1)
    return np.hstack([one, (vote > 0), (vote < 0), np.log1p(length)[:, None] / 4, share[:, None], np.ones((len(kind), 1))]).astype(float)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of every text as parallel arrays (kind, start, end, base, votes, digits)."""
    def run(batches):
        for b in batches:
            cols = {k: [] for k in ("kinds", "starts", "ends", "bases", "votes", "digits")}
            for t in b.column("text"):
                text = t.as_py() or ""
                base, more = find(text)
                rows = [(k, a, z, True) for k, a, z in base] + [(k, a, z, False) for k, a, z in more]
                cols["kinds"].append([KINDS.index(r[0]) for r in rows])
                cols["starts"].append([r[1] for r in rows])
                cols["ends"].append([r[2] for r in rows])
                cols["bases"].append([r[3] for r in rows])
                # six votes as one number to base 3
                cols["votes"].append([sum((v + 1) * 3**i for i, v in enumerate(votes(text, *r))) for r in rows])
                cols["digits"].append([len(_digits(text[r[1]:r[2]])) for r in rows])
            types = {"bases": pa.bool_(), "starts": pa.int64(), "ends": pa.int64()}
            yield batch_with(b, ["doc_id"], **{k: pa.array(v, pa.list_(types.get(k, pa.int32()))) for k, v in cols.items()})

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind_of(docs, 'doc_id')}, kinds array<int>, starts array<bigint>, ends array<bigint>, "
             "bases array<boolean>, votes array<int>, digits array<int>")


def _unpack(code: np.ndarray) -> np.ndarray:
    return np.stack([code // 3**i % 3 - 1 for i in range(len(LABELERS))], 1)


def estimate(kind: np.ndarray, vote: np.ndarray, n: np.ndarray, steps: int = 100):
    """EM over vote patterns with their counts: (prior per kind, table [class, labeler, vote + 1], posteriors)."""
    # start: a labeler mostly votes for its class and abstains alike in both
    table = np.array([[[0.5, 0.35, 0.15]] * len(LABELERS), [[0.15, 0.35, 0.5]] * len(LABELERS)])
    prior = np.full(len(KINDS), 0.5)
    post = np.zeros(len(n))
    for _ in range(steps):
        like = [np.log(table[c][np.arange(len(LABELERS))[None, :], vote + 1]).sum(axis=1) for c in (0, 1)]
        odds = like[1] - like[0] + np.log(prior[kind] / (1 - prior[kind]))
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        done = np.abs(new - post).max(initial=0.0) < 1e-6
        post = new
        for c, w in ((0, n * (1 - post)), (1, n * post)):
            for v in (-1, 0, 1):
                # pseudo-counts in the starting shape keep the classes from changing places
                table[c, :, v + 1] = ((vote == v) * w[:, None]).sum(axis=0) + 5 * (0.15, 0.35, 0.5)[v + 1 if c else 1 - v]
            table[c] /= table[c].sum(axis=1, keepdims=True)
        for k in range(len(KINDS)):
            at = kind == k
            prior[k] = (2 + (n[at] * post[at]).sum()) / (4 + n[at].sum())
        if done:
            break
    return prior, table, post


def fit_classifier(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Logistic regression on soft labels by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(scanned: DataFrame) -> np.ndarray | None:
    """Classifier weights from all candidates' vote patterns and at most TRAIN_SPANS of them."""
    spans = scanned.select("doc_id", F.explode(F.arrays_zip("kinds", "starts", "ends", "votes", "digits")).alias("x")).select("doc_id", "x.*")
    # at most 7 kinds times 3**6 patterns
    counts = spans.groupBy("kinds", "votes").agg(F.count(F.lit(1)).alias("n")).toPandas()
    if not len(counts):
        return None
    counts = counts.sort_values(["kinds", "votes"])
    kind, code = counts["kinds"].to_numpy(), counts["votes"].to_numpy()
    _, _, post = estimate(kind, _unpack(code), counts["n"].to_numpy(float))
    known = dict(zip(zip(kind.tolist(), code.tolist()), post.tolist()))
    light = spans.select("kinds", "votes", "digits", (F.col("ends") - F.col("starts")).alias("length"),
                         F.xxhash64("doc_id", "starts", "kinds").alias("h"))
    sample = first_by_hash(light, F.shiftright("h", 16) + F.lit(1 << 47), 48, ["h", "kinds", "votes", "digits", "length"], TRAIN_SPANS)
    k, v = sample["kinds"].to_numpy(), sample["votes"].to_numpy()
    x = _features(k, _unpack(v), sample["length"].to_numpy(), sample["digits"].to_numpy())
    return fit_classifier(x, np.array([known[p] for p in zip(k.tolist(), v.tolist())]))


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


class _Covered:
    """The union of spans as disjoint intervals in order."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for _, a, z in sorted(spans, key=lambda x: x[1]):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], z)
            else:
                self.starts.append(a)
                self.ends.append(z)

    def add(self, a: int, z: int) -> bool:
        """Adds a span that meets none so far; whether it did."""
        k = bisect.bisect_left(self.starts, z)             # the last one that starts before z is k - 1
        if k and self.ends[k - 1] > a:
            return False
        self.starts.insert(k, a)
        self.ends.insert(k, z)
        return True


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added."""
    scanned = scratch_table(scan(docs), "spans")
    weights = scanned.sparkSession.sparkContext.broadcast(train(scanned))

    def run(batches):
        for b in batches:
            rows = list(zip(*(b.column(c).to_pylist() for c in ("kinds", "starts", "ends", "bases", "votes", "digits"))))
            flat = [np.array([x for r in rows for x in r[c]], np.int64) for c in (0, 1, 2, 4, 5)]
            p = np.zeros(0)
            if len(flat[0]):
                x = _features(flat[0], _unpack(flat[3]), flat[2] - flat[1], flat[4])
                p = 1 / (1 + np.exp(-np.clip(x @ weights.value, -30, 30)))
            counts, digests, spans, added, at = [], [], [], [], 0
            for kinds, starts, ends, bases, _, _ in rows:
                own = [(KINDS[k], a, z) for k, a, z, own_ in zip(kinds, starts, ends, bases) if own_]
                taken, covered = list(own), _Covered(own)
                found = sorted((-float(p[at + i]), kinds[i], starts[i], ends[i]) for i in range(len(kinds)) if not bases[i])
                for q, k, a, z in found:
                    if -q >= ACCEPT and covered.add(a, z):
                        taken.append((KINDS[k], a, z))
                at += len(kinds)
                counts.append([sum(x[0] == k for x in own) for k in KINDS[:4]])
                digests.append(hashlib.sha256(joined(own).encode()).hexdigest())
                spans.append(joined(taken))
                added.append(len(taken) - len(own))
            counts = np.array(counts, np.int64).reshape(-1, 4)
            yield batch_with(b, ["doc_id"], **{f"n_{k}": counts[:, i] for i, k in enumerate(KINDS[:4])},
                             base_sha256=pa.array(digests, pa.string()), spans=pa.array(spans, pa.string()),
                             n_added=pa.array(added, pa.int64()))

    return scanned.mapInArrow(run, f"doc_id {kind_of(docs, 'doc_id')}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                                   "base_sha256 string, spans string, n_added bigint")
