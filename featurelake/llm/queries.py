"""The registered queries of this package and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collisions, decontaminate, hostgraph, jaccard, lines, merkle, packing, pii, repeats, secrets, toxicity, turns, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: CRC-32 of a text before the last complement, bit by bit.
CRC32 = """list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({x}, ''), lambda c: ord(c)::BIGINT)),
    lambda crc, b: list_reduce(list_concat([xor(crc, b)], repeat([0::BIGINT], 8)), lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END))"""


def query(name: str, sql: str | None = None):
    """Register a query under its name, with its equivalent over the same tables if there is one."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


@query("op1_pii_feistel")
def op1_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.pseudonymize(docs, b"the key of this corpus")
    return out.select("doc_id", "text", F.size("pii_spans").cast("long").alias("n_replaced"))


@query("op2_host_graph")
def op2_host_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostgraph.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op3_warc_dictionary")
def op3_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read(warc.write(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_toxicity_chain")
def op4_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.label_categories()))
    return scored.select("doc_id", "p_poor", "p_toxic", (F.col("p_toxic") >= toxicity.REJECT).alias("rejected"))


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.cut(table(spark, sf_dir, "documents")))


@query("op7_decontamination", """
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS t FROM documents),
i AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS t FROM benchmark),
items AS (
  SELECT DISTINCT item_id, width, unnest(list_transform(range(1, len(t) - width + 2), lambda k: array_to_string(t[k:k + width - 1], ' '))) AS s
  FROM (SELECT item_id, t, least(len(t), 5) AS width FROM i WHERE len(t) > 0)),
docs AS (
  SELECT DISTINCT doc_id, width, unnest(list_transform(range(1, len(t) - width + 2), lambda k: array_to_string(t[k:k + width - 1], ' '))) AS s
  FROM d, (SELECT DISTINCT width FROM items) WHERE len(t) >= width),
sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY 1)
SELECT doc_id, item_id, any_value(n) AS n_shingles, count(*) AS n_shared
FROM docs JOIN items USING (width, s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= ceil(0.8 * any_value(n) - 1e-9)
""")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.find_secrets(table(spark, sf_dir, "documents")))


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


@query("op5_collision_search")
def op5_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op10_repeated_bytes")
def op10_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_line_dedup", """
WITH l AS (
  SELECT doc_id, generate_subscripts(x, 1) AS k, unnest(x) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
many AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT doc_id, k, line, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN many USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""")
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedupe_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op12_merkle_manifest", """
WITH RECURSIVE d AS (
  SELECT *, """ + CRC32.format(x="doc_id::VARCHAR") + """ AS crc
  FROM documents),
e AS (SELECT *, crc IS NOT NULL AND xor(crc, 4294967295) % 7 = 0 AS tampered FROM d),
f AS (
  SELECT doc_id, lang, tampered, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
    coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS b, coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS b2,
    coalesce(strlen(text) || ':' || text, '-') AS c FROM e),
leaves AS (
  SELECT doc_id, lang, sha256(a || b || c) AS leaf, CASE WHEN tampered THEN sha256(a || b2 || c) ELSE sha256(a || b || c) END AS found,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM f),
tree AS (
  SELECT 0 AS lvl, lang, i, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lvl + 1, lang, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY lvl, lang, i // 2, n),
subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER () AS m FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS lvl, g, m, subroot AS h FROM subroots
  UNION ALL
  SELECT lvl + 1, g // 2, (m + 1) // 2, sha256(string_agg(h, '' ORDER BY g)) FROM top WHERE m > 1 GROUP BY lvl, g // 2, m),
walk AS (
  SELECT doc_id, lang, 0 AS lvl, i, n, found AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT w.doc_id, w.lang, w.lvl + 1, w.i // 2, (w.n + 1) // 2,
    sha256(CASE WHEN s.i IS NULL THEN w.h WHEN s.i < w.i THEN s.h || w.h ELSE w.h || s.h END), w.proof || coalesce(s.h, '')
  FROM walk w LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM w.lang AND s.lvl = w.lvl AND s.i = xor(w.i, 1) WHERE w.n > 1),
climb AS (
  SELECT doc_id, subroot, 0 AS lvl, g, m, h, proof FROM walk JOIN subroots ON subroots.lang IS NOT DISTINCT FROM walk.lang WHERE n = 1
  UNION ALL
  SELECT w.doc_id, w.subroot, w.lvl + 1, w.g // 2, (w.m + 1) // 2,
    sha256(CASE WHEN s.g IS NULL THEN w.h WHEN s.g < w.g THEN s.h || w.h ELSE w.h || s.h END), w.proof || coalesce(s.h, '')
  FROM climb w LEFT JOIN top s ON s.lvl = w.lvl AND s.g = xor(w.g, 1) WHERE w.m > 1)
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, c.h AS folded_root, c.h = r.h AS verified
FROM climb c JOIN leaves USING (doc_id) JOIN top r ON r.m = 1 WHERE c.m = 1
""")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, sf_dir, "documents").select(*fields, merkle.leaf_hash(fields).alias("leaf"))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    docs = docs.withColumn("n_chars", F.when(tampered, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars")))
    docs = docs.select("doc_id", "lang", "leaf", F.when(tampered, merkle.leaf_hash(fields)).otherwise(F.col("leaf")).alias("found"))
    rows = merkle.manifest(docs, "lang", "doc_id").withColumn("folded_root", merkle.fold("found", "chain"))
    digests = [merkle.hex_text(c).alias(c) for c in ("leaf", "subroot", "root", "folded_root")]
    return rows.select(
        "doc_id", *digests, F.sha2(merkle.hex_text(merkle.proof("chain")), 256).alias("proof_sha256"),
        (F.col("folded_root") == F.col("root")).alias("verified"))


def repair_sql() -> str:
    """The repair as a recursion over the rows of all conversations at once, with cost, audit and text of each state."""

    def step(state: str, cost: str, letters: str, lines: str) -> str:
        return f"CASE WHEN {state} IS NOT NULL THEN {{c: {state}.c + {cost}, a: {state}.a || '{letters}', t: {state}.t || {lines}}} END"

    def some(condition: str, steps: list[str]) -> list[str]:
        return [f"CASE WHEN {condition} THEN {s} END" for s in steps]

    keep, user, assistant = "chr(10) || role || ':' || text", "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    before = {"u": ["e", "s", "a"], "a": ["u"]}  # states that a user or an assistant can follow
    line = {"u": user, "a": assistant}
    ways = {x: [step(x, "3", "D", "''")] for x in "esua"}
    ways["s"] += some("NOT must AND x = 's'", [step("e", "cut", "K", keep)])
    for x in "ua":
        other = "a" if x == "u" else "u"
        ways[x] += [step(b, "5", "ID", line[x]) for b in before[x]]
        ways[x] += some(f"NOT must AND x = '{x}'", [step(b, "cut", "K", keep) for b in before[x]])
        ways[x] += some(f"NOT must AND x = '{x}'", [step(b, "2 + cut", "IK", f"{line[other]} || {keep}") for b in before[other]])
        ways[x] += some("NOT must", [step(b, "2 + cut", "R", f"{line[x]} || text") for b in before[x]])
        ways[x] += some("NOT must", [step(b, "4 + cut", "IR", f"{line[other]} || {line[x]} || text") for b in before[other]])
    moves = ",\n    ".join(f"list_min([{', '.join(w)}]) AS {x}" for x, w in ways.items())
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor({CRC32.format(x="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")}, 4294967295) % 20 AS fate FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM c WHERE fate <> 0),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k, rtrim(text, {blanks}) AS body FROM d),
q AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS again, left(role, 1) AS x,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS y FROM p),
r AS (
  SELECT *, body = '' AS blank, body <> '' AND again AS twice, body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS open,
    body = '' OR again AS must, (body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?'))::BIGINT AS cut FROM q),
dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS k, {{c: 0::BIGINT, a: '', t: ''}} AS e, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s,
    NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS u, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS a FROM conversations
  UNION ALL
  SELECT dp.conv_id, r.k,
    {moves}
  FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.k = dp.k + 1),
ends AS (
  SELECT conv_id, list_min([e, a, {step("u", "2", "I", assistant)}]) AS z
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) AS last FROM dp) WHERE last = 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (twice) AS duplicate, count(*) FILTER (open) AS truncated,
    count(*) FILTER (k > 1 AND y || x NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
SELECT ends.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, z.c AS cost, z.a AS audit, sha256(substr(z.t, 2)) AS repaired_sha256
FROM ends LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ends.conv_id
"""


@query("op11_conversation_repair", repair_sql())
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    done = turns.repair(turns.damaged(rows))
    found = turns.on_keys(done.report.drop("end"), done.audit(), ["conv"])
    found = turns.on_keys(found, turns.digests(done.repaired()), ["conv"], "left")
    every = rows.select(F.col("conv_id").alias("conv")).distinct()
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return turns.on_keys(every, found, ["conv"], "left").select(
        F.col("conv").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
