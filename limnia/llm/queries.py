"""One registered query for each operator, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limnia.llm import decontamination, fim, jaccard, language, lines, lm, merkle, order, packing, quality, topk, toxicity, url_rules
from limnia.llm.common import remainder, shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_rules.judge(pages, url_rules.DECIDING + url_rules.BLOCKING)
    return judged.select("page_id", *(F.col(f"_{c}").alias(c) for c in ("host", "path", "rule", "verdict")))


_BLOCKED = " OR ".join(f"regexp_matches(whole, '{url_rules.to_regex(r.pattern)}', 's')" for r in url_rules.BLOCKING)
ORACLES["op2_url_rules"] = f"""
WITH p AS (
    SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{url_rules.UPPER}', '{url_rules.LOWER}') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
           translate(coalesce(regexp_extract(url, '://(.*)', 1, 's'), ''), '{url_rules.UPPER}', '{url_rules.LOWER}') AS whole
    FROM pages
),
r(h, start, rule, verdict) AS (VALUES
    ('org', '/', 'org/', 'allow'), ('example.org', '/es/', 'example.org/es/', 'block'),
    ('example.org', '/en/1', 'example.org/en/1', 'block'), ('com', '/fr/', 'com/fr/', 'allow'), ('com', '/de/', 'com/de/', 'block')
),
f AS (SELECT *, (SELECT max_by(r, length(r.rule)) FROM r WHERE (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.start)) AS x FROM p)
SELECT page_id, host, path, x.rule AS rule,
       CASE WHEN x IS NOT NULL THEN x.verdict WHEN {_BLOCKED} THEN 'block' ELSE 'allow' END AS verdict
FROM f
"""


@query
def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


ORACLES["op3_topk"] = """
WITH v AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort("_items"), ",")
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        (F.col("_n_hit") > 0).alias("contaminated"),
    )


ORACLES["op4_decontamination"] = r"""
WITH i AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL
),
win AS (
    SELECT DISTINCT id, w[p:p + least(10, len(w)) - 1] AS g
    FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)
),
d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
),
dw AS (
    SELECT r, p, n, w[p:p + n - 1] AS g
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT len(g) AS n FROM win))
),
h AS (SELECT dw.r, dw.p, dw.n, win.id FROM dw JOIN win ON dw.g = win.g),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM h) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS names FROM (SELECT DISTINCT r, id FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = language.train(docs.filter(~held_out))
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score")
    )


@query
def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 10) == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, counts = lm.train(docs.filter(~held_out))
    return lm.score(docs, model, counts, keep=["doc_id"]).select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("_n_tokens").alias("n_tokens"),
        F.col("_n_known").alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        F.col("_base").alias("base_score"),
        F.col("_score").alias("score"),
    )


@query
def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(table(spark, sf_dir, "documents"))


ORACLES["op7_jaccard"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
s AS (
    SELECT DISTINCT doc_id, w[p:p + least(4, len(w)) - 1] AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM i JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
m AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id
FROM d JOIN m ON m.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = lines.LineIndex(spark)
    index.insert(docs)
    dropped = F.size("_dropped").cast("long").alias("n_dropped")
    return index.clean(docs).select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        dropped,
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


ORACLES["op8_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
),
r AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.keep AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query
def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = order.written(table(spark, sf_dir, "documents"), shared_folder(spark))
    return shards.select("slot", "shard", "byte_offset", "number", "n_tokens", F.crc32("ids").alias("ids_crc32"), "ids")


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = toxicity.train(docs.filter(~held_out), labels.filter(~held_out).select("doc_id", "toxic"))
    return toxicity.evidence(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("_score").alias("score"),
        F.when(F.col("_score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


MANIFEST = ("doc_id", "source", "lang", "n_chars", "text")


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {c: F.col(c) for c in MANIFEST}
    changed = merkle.leaf(list({**values, "n_chars": F.col("n_chars") + 1}.values()))
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0  # not for a null id
    docs = table(spark, sf_dir, "documents").select(*MANIFEST, F.when(chosen, changed).alias("_changed"))
    made = merkle.manifest(docs, MANIFEST, group="lang", key="doc_id", keep=["doc_id", "_changed"])
    folded = made.withColumn("folded_root", merkle.fold(F.coalesce("_changed", "_leaf"), F.col("_proof")))
    return folded.select(
        "doc_id",
        F.col("_leaf").alias("leaf"),
        F.col("_subroot").alias("subroot"),
        F.col("_root").alias("root"),
        merkle.digest(merkle.siblings(F.col("_proof"))).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("_root")).alias("verified"),
    )


# crc32 by its table of 256 remainders; then levels upwards, and each leaf's fold upwards.
_FIELDS = "||".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in MANIFEST)
ORACLES["op11_merkle"] = f"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) AS r(i)
),
d AS (
    SELECT row_number() OVER () AS r, coalesce('=' || lang, '') AS lk, doc_id, sha256({_FIELDS}) AS leaf,
           sha256({_FIELDS.replace("n_chars::", "(n_chars + 1)::")}) AS changed,
           xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')]),
                           lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 7 = 0 AS chosen
    FROM documents, crc
),
n AS (
    SELECT *, row_number() OVER (PARTITION BY lk ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lk) AS n FROM d
),
low AS (
    SELECT lk, 0 AS l, i, n, leaf AS h FROM n
    UNION ALL
    SELECT lk, l + 1, i >> 1, (n + 1) >> 1, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY lk, l, i >> 1, n
),
g AS (SELECT lk, h AS subroot, row_number() OVER (ORDER BY lk) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
    SELECT 0 AS l, i, n, subroot AS h FROM g
    UNION ALL
    SELECT l + 1, i >> 1, (n + 1) >> 1, sha256(string_agg(h, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY l, i >> 1, n
),
s AS (
    SELECT n.r, s.l, (n.i >> s.l) & 1 AS own, s.h FROM n JOIN low s ON s.lk = n.lk AND s.i = xor(n.i >> s.l, 1) AND s.n > 1
    UNION ALL
    SELECT n.r, 100 + s.l, (g.i >> s.l) & 1, s.h FROM n JOIN g USING (lk) JOIN high s ON s.i = xor(g.i >> s.l, 1) AND s.n > 1
),
lv AS (
    SELECT n.r, x.l, s.own, coalesce(s.h, '') AS h, row_number() OVER (PARTITION BY n.r ORDER BY x.l) AS k
    FROM n JOIN (SELECT DISTINCT lk, l FROM low WHERE n > 1 UNION ALL SELECT DISTINCT g.lk, 100 + l FROM g, high WHERE high.n > 1) x USING (lk)
    LEFT JOIN s ON s.r = n.r AND s.l = x.l
),
fold AS (
    SELECT r, 0 AS k, CASE WHEN chosen THEN changed ELSE leaf END AS h FROM n
    UNION ALL
    SELECT fold.r, lv.k, sha256(CASE WHEN lv.own = 1 THEN lv.h || fold.h ELSE fold.h || lv.h END)
    FROM fold JOIN lv ON lv.r = fold.r AND lv.k = fold.k + 1
),
folded AS (SELECT r, max_by(h, k) AS folded_root FROM fold GROUP BY r),
proof AS (SELECT r, string_agg(h, '' ORDER BY k) AS p FROM lv GROUP BY r)
SELECT doc_id, leaf, subroot, top.h AS root, sha256(coalesce(p, '')) AS proof_sha256, folded_root, folded_root = top.h AS verified
FROM n JOIN g USING (lk) JOIN folded USING (r) LEFT JOIN proof USING (r), (SELECT h FROM high WHERE n = 1) top
"""


@query
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 3) == 1
    weights = quality.train(docs.filter(~held_out), labels.filter(~held_out).select("doc_id", "quality"))
    return quality.score(docs, weights).select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("_score").alias("score"),
        F.when(F.col("_score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query
def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents"), seed=42, rate=50, spm=80)
    restored = fim.restore(F.col("_output"), F.col("_form"))
    return made.select(
        "doc_id",
        F.col("_n").alias("n"),
        F.col("_form").alias("form"),
        F.col("_prefix_chars").alias("prefix_chars"),
        F.col("_middle_chars").alias("middle_chars"),
        F.sha2(F.col("_output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"),
    )


ORACLES["op13_fim"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
    FROM documents
),
h AS (
    SELECT *, ('0x' || x[1:8])::BIGINT % (len(u) + 1) AS c1, ('0x' || x[9:16])::BIGINT % (len(u) + 1) AS c2,
           ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4
    FROM d
),
f AS (
    SELECT doc_id, t, len(u) AS n,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(u[1:least(c1, c2)], '') AS p,
           array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
           array_to_string(u[greatest(c1, c2) + 1:], '') AS s
    FROM h
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""
