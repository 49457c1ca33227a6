"""The registered queries opN_<name> over whole tables, and DuckDB SQL where it can express them."""
from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, dedup, langid, merkle, mixing, nearjoin, pagediff, pii, quality, repeats, secrets, turns, urlrules
from .common import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_secret_scan(spark, sf_dir):
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op2_bpe(spark, sf_dir, tokenizer: str | None = None):
    return bpe.encode(table(spark, sf_dir, "documents"), tokenizer or tokenizer_path())


def op3_url_filter(spark, sf_dir):
    return urlrules.filter_urls(table(spark, sf_dir, "pages"), urlrules.default_rules(spark))


def op4_quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark, sf_dir):
    return pagediff.extract(table(spark, sf_dir, "pages"))


def op7_jaccard_join(spark, sf_dir):
    return nearjoin.near_classes(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark, sf_dir):
    return dedup.dedup_report(table(spark, sf_dir, "documents"))


def op9_mixing(spark, sf_dir):
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_pii(spark, sf_dir):
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark, sf_dir):
    return turns.repair(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_suffix_dedup(spark, sf_dir):
    return repeats.strip_repeats(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_bpe, op3_url_filter, op4_quality_rules, op5_language_id,
                                   op6_html_extraction, op7_jaccard_join, op8_exact_dedup, op9_mixing, op10_pii, op11_conversation_repair,
                                   op12_merkle_manifest, op13_suffix_dedup)}

_SPACE = r"[\x20\x09-\x0D]+"

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urlrules.RULES)

_CRC_TABLE = ("list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: "
              "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))")


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string; the query has a table crc(t) of _CRC_TABLE."""
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _least(*ways: str) -> str:
    return f"list_sort(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))[1]"


def _edit(state: str, cost: str, initial: str, line: str = "''", when: str = "true") -> str:
    """A state of the repair after one more edit: k has the cost in nine digits and the audit, t the repaired lines."""
    return (f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'k': lpad((left({state}.k, 9)::INT + {cost})::VARCHAR, 9, '0') || "
            f"substr({state}.k, 10) || '{initial}', 't': {state}.t || {line}}} END")


def _inserted(s0: str, s1: str, s2: str, s3: str) -> str:
    """The four states with rows inserted where that is cheaper."""
    more = _least(s2, *(_edit(s, "2", "I", "'user:' || chr(10)") for s in (s0, s1, s3)))
    return f"SELECT cid, i, {s0}, {s1}, c2, {_least(s3, _edit('c2', '2', 'I', "'assistant:' || chr(10)"))} FROM (SELECT *, {more} AS c2 FROM n)"


def _row_edits() -> str:
    stay = "e.fault IN ('k', 't')"
    more = "(e.fault = 't')::INT"
    line, user, assistant = ("role || ':' || text || chr(10)", "'user:' || text || chr(10)", "'assistant:' || text || chr(10)")
    keep = lambda s, c: _edit(s, more, "K", line, f"{stay} AND left(role, 1) = '{c}'")
    turn = lambda s, to: _edit(s, f"2 + {more}", "R", to, stay)
    drop = lambda s: _edit(s, "3", "D")
    return ", ".join((f"{drop('s0')} AS n0", f"{_least(drop('s1'), keep('s0', 's'))} AS n1",
                      f"{_least(drop('s2'), *(keep(s, 'u') for s in ('s0', 's1', 's3')), *(turn(s, user) for s in ('s0', 's1', 's3')))} AS n2",
                      f"{_least(drop('s3'), keep('s2', 'a'), turn('s2', assistant))} AS n3"))


ORACLES = {
    "op3_url_filter": rf"""
WITH rules(verdict, rule_host, rule_path) AS (VALUES {_RULES}),
u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1, 's'), ''),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2, 's'), '') AS path, row_number() OVER () AS rid FROM pages),
m AS (SELECT u.rid, r.rule_host || r.rule_path AS rule, r.verdict,
             row_number() OVER (PARTITION BY u.rid ORDER BY length(r.rule_host || r.rule_path) DESC, length(r.rule_host) DESC) AS k
      FROM u JOIN rules r ON (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host)) AND starts_with(u.path, r.rule_path))
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM u LEFT JOIN m ON m.rid = u.rid AND m.k = 1""",

    "op7_jaccard_join": rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
      WHERE 5 * common >= 4 * (nx.c + ny.c - common)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
c AS (SELECT x AS doc_id, min(y) AS class_id, count(*) AS class_size FROM r GROUP BY x)
SELECT c.doc_id, class_id, class_size, (SELECT count(*) FROM l WHERE l.x = c.doc_id) AS n_links FROM c""",

    "op8_exact_dedup": rf"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g')) AS text_sha256,
                  row_number() OVER () AS rid FROM documents),
g AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
             row_number() OVER w = 1 AS kept
      FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST, rid))
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM g""",

    "op9_mixing": rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n,
             [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM d GROUP BY source),
lvl(i, level, capped) AS (
  SELECT 0, 0.0::DOUBLE, -1::BIGINT
  UNION ALL
  SELECT i + 1, (SELECT (1.5 * sum(source_size) - coalesce(sum(2.0 * source_size) FILTER (WHERE lvl.level * w > 2.0 * source_size), 0))
                        / nullif(sum(w) FILTER (WHERE NOT lvl.level * w > 2.0 * source_size), 0) FROM s),
         (SELECT count(*) FILTER (WHERE lvl.level * w > 2.0 * source_size) FROM s)
  FROM lvl WHERE i < 60 AND level IS NOT NULL),
t AS (SELECT s.*, least((SELECT max(level) FROM lvl) * w, 2.0 * source_size) AS target FROM s),
r AS (SELECT d.*, t.source_size, t.target, t.n, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
u AS (SELECT *, floor(rate) AS whole, target - floor(rate) * source_size AS need, least(greatest(length(bin(size)), 4), 13)::DOUBLE AS odds,
             (('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u01
      FROM r),
o AS (SELECT source, odds, sum(size)::DOUBLE AS words, any_value(need) AS need FROM u WHERE need > 0 GROUP BY source, odds),
f AS (SELECT source, odds, (need - coalesce(sum(words) OVER (PARTITION BY source ORDER BY odds DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / nullif(sum(odds * words) OVER (PARTITION BY source ORDER BY odds ROWS UNBOUNDED PRECEDING), 0) AS factor FROM o),
w AS (SELECT source, arg_max(factor, odds) FILTER (WHERE factor * odds <= 1) AS factor FROM f GROUP BY source),
k AS (SELECT u.*, least(greatest(coalesce(w.factor, 0) * odds, 1e-12), 0.999999999) AS p FROM u LEFT JOIN w ON u.source IS NOT DISTINCT FROM w.source),
q AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY (u01 / (1 - u01)) / (p / (1 - p)), doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM k)
SELECT doc_id, size, source_size, target,
       ((whole + CASE WHEN need > 0 AND upto - size / 2.0 <= need THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM q""",

    "op12_merkle_manifest": rf"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS t),
d AS MATERIALIZED (SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, {_leaf("(n_chars::HUGEINT + 1)")} AS bad,
      doc_id IS NOT NULL AND n_chars IS NOT NULL AND {_crc32("doc_id::VARCHAR")} % 7 = 0 AS hit, row_number() OVER () AS rid
      FROM documents, crc),
p AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree,
      row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos FROM d),
up(tree, l, pos, h, n) AS (
  SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM p
  UNION ALL
  SELECT tree, l + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2) FROM up WHERE n > 1 GROUP BY tree, l, pos // 2),
nodes AS MATERIALIZED (SELECT * FROM up),
sub AS MATERIALIZED (SELECT tree, l AS top, h FROM nodes WHERE n = 1),
up2(l, pos, h, n) AS (
  SELECT 0, tree - 1, h, count(*) OVER () FROM sub
  UNION ALL
  SELECT l + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2) FROM up2 WHERE n > 1 GROUP BY l, pos // 2),
over AS MATERIALIZED (SELECT * FROM up2),
way AS MATERIALIZED (
  SELECT p.rid, g.l, s.h, s.pos < (p.pos >> g.l) AS on_left
  FROM p JOIN sub USING (tree), unnest(range(sub.top)) AS g(l)
  LEFT JOIN nodes s ON s.tree = p.tree AND s.l = g.l AND s.pos = xor(p.pos >> g.l, 1)
  UNION ALL
  SELECT p.rid, sub.top + g.l, s.h, s.pos < ((p.tree - 1) >> g.l)
  FROM p JOIN sub USING (tree), unnest(range((SELECT max(l) FROM over))) AS g(l)
  LEFT JOIN over s ON s.l = g.l AND s.pos = xor((p.tree - 1) >> g.l, 1)),
proof AS (SELECT rid, sha256(coalesce(string_agg(h, '' ORDER BY l), '')) AS proof_sha256 FROM way GROUP BY rid),
f(rid, l, node) AS (
  SELECT rid, 0, CASE WHEN hit THEN bad ELSE leaf END FROM p
  UNION ALL
  SELECT f.rid, f.l + 1, sha256(CASE WHEN w.h IS NULL THEN node WHEN on_left THEN w.h || node ELSE node || w.h END)
  FROM f JOIN way w ON w.rid = f.rid AND w.l = f.l),
folded AS (SELECT rid, arg_max(node, l) AS folded_root FROM f GROUP BY rid)
SELECT p.doc_id, p.leaf, sub.h AS subroot, o.h AS root, coalesce(proof.proof_sha256, sha256('')) AS proof_sha256,
       folded_root, folded_root = o.h AS verified
FROM p JOIN sub USING (tree) JOIN folded USING (rid) LEFT JOIN proof USING (rid) JOIN over o ON o.n = 1""",

    "op11_conversation_repair": rf"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS t),
x AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS cid,
             coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
y AS (SELECT x.*, {_crc32("k")} % 20 AS code FROM x, crc),
r AS (SELECT cid, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
             CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM y, unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))),
o AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
             right(regexp_replace(text, '{_SPACE}\z', ''), 1) AS last FROM r),
e AS MATERIALIZED (SELECT *, CASE WHEN last = '' THEN 'b' WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY i) > 1 THEN 'd'
                                  WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE 'k' END AS fault,
                          coalesce(lag(left(role, 1)) OVER (PARTITION BY cid ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal FROM o),
dp(cid, i, s0, s1, s2, s3) AS (
  SELECT cid, 0, {{'k': '000000000', 't': ''}}, NULL::STRUCT(k VARCHAR, t VARCHAR), {{'k': '000000002I', 't': 'user:' || chr(10)}},
         {{'k': '000000004II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)}} FROM (SELECT DISTINCT cid FROM x)
  UNION ALL
  (WITH n AS (SELECT dp.cid, e.i, {_row_edits()} FROM dp JOIN e ON e.cid = dp.cid AND e.i = dp.i + 1)
   {_inserted("n0", "n1", "n2", "n3")})),
done AS (SELECT cid, arg_max({_least("s0", "s3")}, i) AS s FROM dp GROUP BY cid),
n AS (SELECT cid, coalesce(max(turn)::HUGEINT - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
             count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
             count(*) FILTER (WHERE illegal) AS illegal FROM e GROUP BY cid)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, left(s.k, 9)::BIGINT AS cost, substr(s.k, 10) AS audit,
       sha256(left(s.t, greatest(length(s.t) - 1, 0))) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, cid FROM x) c JOIN done USING (cid) LEFT JOIN n USING (cid)""",

    "op13_suffix_dedup": f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
c AS MATERIALIZED (SELECT rid, j, substr(hx, 8192 * j + 1, 8192 + {2 * repeats.LENGTH - 2}) AS part FROM d, unnest(range((length(hx) + 8191) // 8192)) AS u(j)),
w AS MATERIALIZED (SELECT rid, 4096 * j + i AS pos, md5(substr(part, 2 * i + 1, {2 * repeats.LENGTH})) AS h FROM c, unnest(range(greatest(0, least(4096, length(part) // 2 - {repeats.LENGTH - 1})))) AS u(i)),
m AS (SELECT rid, pos FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
e AS (SELECT rid, pos, CASE WHEN pos - lag(pos) OVER (PARTITION BY rid ORDER BY pos) <= {repeats.LENGTH} THEN 0 ELSE 1 END AS fresh FROM m),
g AS (SELECT rid, pos, sum(fresh) OVER (PARTITION BY rid ORDER BY pos) AS k FROM e),
s AS (SELECT rid, k, min(pos) AS a, max(pos) + {repeats.LENGTH} AS b FROM g GROUP BY rid, k),
t AS (SELECT rid, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS last,
             string_agg(substr(hx, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM (SELECT s.*, hx, lag(b, 1, 0) OVER (PARTITION BY rid ORDER BY a) AS before FROM s JOIN d USING (rid)) GROUP BY rid)
SELECT doc_id, length(hx) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(hx, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (rid)""",
}
