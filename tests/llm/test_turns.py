import itertools
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest

from ratecast.llm import queries, turns

from .conftest import rows_of

CONV = "conv_id bigint, turn bigint, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def sp(v):
    return " " if v is None else str(v)


def damage(rows):
    out = []
    for c, t, role, text in rows:
        code = zlib.crc32(f"{sp(c)}:{sp(t)}".encode()) % 20
        role, text = sp(role), sp(text)
        if code:
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            out += [(c, t, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(BLANK)
        out.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "k")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """Plain dynamic programme over prefixes with whole (cost, audit, lines) values."""
    def insert(best):
        for _ in range(3):
            for q, v in list(best.items()):
                role, to = ("assistant", "a") if q == "u" else ("user", "u")
                new = (v[0] + 2, v[1] + "I", v[2] + (f"{role}:",))
                best[to] = min(best.get(to, new), new)
        return best
    best = insert({"": (0, "", ())})
    for (_, _, role, text), f in zip(rows, fault):
        new = {}
        for q, (cost, audit, lines) in best.items():
            ways = [(q, cost + 3, "D", ())]
            if f in "kt":
                if (q, role[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    ways.append((role[:1], cost + (f == "t"), "K", (f"{role}:{text}",)))
                to = "assistant" if q == "u" else "user"
                ways.append((to[0], cost + 2 + (f == "t"), "R", (f"{to}:{text}",)))
            for to, c, e, line in ways:
                v = (c, audit + e, lines + line)
                new[to] = min(new.get(to, v), v)
        best = insert(new)
    return min(best[q] for q in ("", "a") if q in best)


def brute_repair(rows):
    out = []
    for c in {r[0] for r in rows}:
        d = sorted(damage([r for r in rows if r[0] == c]),
                   key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), sha256(r[3].encode()).digest()))
        f = faults(d)
        cost, audit, lines = cheapest(d, f)
        at = {r[1] for r in d} - {None}
        out.append({"conv_id": c, "gaps": min(max(at) - min(at) + 1 - len(at), 2**63 - 1) if at else 0, "blank": f.count("b"), "duplicate": f.count("d"),
                    "truncated": f.count("t"), "illegal": sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(d, d[1:])),
                    "cost": cost, "audit": audit, "repaired_sha256": sha256("\n".join(lines).encode()).hexdigest()})
    return rows_of(out)


@pytest.mark.parametrize("n", range(5))
def test_search_on_every_short_conversation(n):
    for code in itertools.product("suaxSUA-", repeat=n):
        rows = [(0, k, c.lower() if c != "-" else "q", "" if c == "-" else f"{k}" + ("" if c.isupper() else ".")) for k, c in enumerate(code)]
        cost, audit, _ = cheapest(rows, ["b" if c == "-" else "t" if c.isupper() else "k" for c in code])
        assert turns.best_edits("".join(code)) == (cost, audit)


def test_search_on_long_conversations():
    rng = np.random.default_rng(1)
    for n in (50, 400):
        for _ in range(30):
            code = rng.choice(list("sssuuuuuaaaaaxUA-"), n)
            rows = [(0, k, c.lower() if c != "-" else "q", f"{k}.") for k, c in enumerate(code)]
            cost, audit, _ = cheapest(rows, ["b" if c == "-" else "t" if c.isupper() else "k" for c in code])
            assert turns.best_edits("".join(code)) == (cost, audit)
    cost, audit = turns.best_edits("ua" * 100_000 + "uu" + "a" * 50_000)
    assert len(audit) >= 250_000 and cost > 0


ROLES = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "umbrella", "Éa"]
TEXTS = ["Hi.", "Hi", "Why?! ", " \t\n", "", None, "a.\x1c", "b ", "c!\x0b\x0c", "Done...", "x y."]


def mixed(n, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        c, t = int(rng.integers(0, n // 6 + 1)), int(rng.integers(-2, 9))
        rows.append((None if c == 0 else c, None if t == 8 else t, ROLES[rng.integers(len(ROLES))], TEXTS[rng.integers(len(TEXTS))]))
    return rows


TRICKY = [(None, None, None, None)] * 5 + [(2**62, -2**63, "user", "a."), (2**62, 2**63 - 1, "assistant", "b."), (77, 1, "user", "z" * 400_000 + "."),
                                           (77, 2, "assistant", " " * 300_000), (77, 3, "assistant", "ok.")]


@pytest.mark.parametrize("rows", [[], mixed(5), mixed(400) + TRICKY, mixed(60) * 3])
def test_repair_against_brute_force(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, CONV).repartition(5).withColumn("head", F.lit(1)).withColumn("audit", F.lit("K")).withColumn("copies", F.lit(9))
    assert rows_of(turns.repair(df).collect()) == brute_repair(rows)


def test_conversations_without_rows_left(spark):
    gone = [c for c in range(400) if zlib.crc32(f"{c}:1".encode()) % 20 == 0]
    got = turns.repair(spark.createDataFrame([(c, 1, "user", "x.") for c in gone], CONV)).collect()
    assert sorted(r.conv_id for r in got) == gone
    assert {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())}


def test_one_hot_conversation(spark, oracle):
    rows = [(5, t, ROLES[t % 3], f"{t}." if t % 7 else "same.") for t in range(4000)] + mixed(300)
    df = spark.createDataFrame(rows, CONV).repartition(6)
    assert rows_of(turns.repair(df).collect()) == brute_repair(rows)


def test_repair_oracle(spark, sf, oracle):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    got = rows_of(queries.op11_conversation_repair(spark, sf).collect())
    assert got == brute_repair([tuple(r) for r in df.collect()])
    assert got == oracle(queries.ORACLES["op11_conversation_repair"], conversations=df)
    rows = [r for r in mixed(200, 9) if r[2] != "Éa"]
    small = spark.createDataFrame(rows, CONV)
    assert brute_repair(rows) == oracle(queries.ORACLES["op11_conversation_repair"], conversations=small)
