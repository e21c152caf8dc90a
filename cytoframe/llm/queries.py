"""The registered queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import byte_bpe, chat_format, embedding_dedup, fill_in_middle, fingerprint, lexical_search, license_scan, line_dedup, minhash_dedup, packing, quality, toxicity, url_filter
from .common import table

URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, vectors = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(vectors, model).select("doc_id", "held_out", "score", "predicted", "evidence")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return byte_bpe.digest_documents(table(spark, sf_dir, "documents"), public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES) + " AS r(host, path, verdict)")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).select("doc_id", "n_sentences", "licenses")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_duplicates(table(spark, sf_dir, "embeddings"))


def event_log(rows: DataFrame) -> DataFrame:
    """A log whose fold gives the rows (conv_id, turn, role, text) back: texts come in two pieces; every third is then
    replaced by a draft and edited back; a reply is followed by a false start that its regeneration drops. Turns that
    several rows of a conversation share, and rows without a turn, come as messages of their own. Rows are dealt by conversation once, before they
    become events, and stay there until the conversation is one text."""
    n = F.count("*").over(Window.partitionBy("conv_id", "turn"))
    r = rows.repartition("conv_id").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"), n.alias("n"))
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    own = F.col("turn").cast("string")

    def event(k: int, kind: str, text, role=F.col("role"), name=own):
        return F.struct(F.lit(k).alias("k"), F.lit(kind).alias("kind"), name.alias("message_id"), role.alias("role"), text.alias("text"))

    nobody, third, reply = F.lit(None).cast("string"), F.pmod("turn", F.lit(3)) == 0, F.col("role") == "assistant"
    whole = event(0, "message", F.col("text"), name=nobody)
    pieces = [event(0, "message", F.substr("text", F.lit(1), half)), event(1, "delta", F.substr("text", half + 1, size), nobody)]
    edits = [event(2, "edit", F.concat(F.lit("draft of "), "text"), nobody), event(3, "delta", F.lit(" and more"), nobody), event(4, "edit", F.col("text"), nobody)]
    again = [event(5, "message", F.lit("a false start"), F.lit("assistant"), F.concat(own, F.lit(" false"))), event(6, "regenerate", F.substr("text", F.lit(1), half), nobody), event(7, "delta", F.substr("text", half + 1, size), nobody)]
    events = F.when((F.col("n") > 1) | F.col("turn").isNull(), F.array(whole)).when(third & reply, F.array(*pieces, *edits, *again)).when(third, F.array(*pieces, *edits)).when(reply, F.array(*pieces, *again)).otherwise(F.array(*pieces))
    e = r.select("conv_id", "turn", F.explode(events).alias("e"))
    return e.select("conv_id", (F.col("turn") * 8 + F.col("e.k")).alias("seq"), "e.kind", "e.message_id", "e.role", "e.text")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(own).alias("text"))
    events = event_log(rows.unionByName(extra))
    done = chat_format.render(chat_format.fold(events)).select("conv_id", "formatted", chat_format.parse(F.col("formatted")).alias("turns"), chat_format.learned(F.col("formatted"), F.col("loss")).alias("learned"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    back = fill_in_middle.restore(F.col("output"), F.col("form"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(lexical_search.index_documents(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.repeated_lines(table(spark, sf_dir, "documents"), carry=("text",))
    kept = line_dedup.kept_text(F.coalesce("text", F.lit("")), F.col("keep"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(kept, 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_packing, op3_quality, op4_fingerprint, op5_byte_bpe, op6_url_filter, op7_license_scan, op8_embedding_dedup, op9_chat_format, op10_minhash_dedup, op11_fill_in_middle, op12_lexical_search, op13_line_dedup)}

_OP6 = """
WITH r(host, path, verdict) AS (VALUES {rules}),
u AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT row_number() OVER () AS n, page_id,
             translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
w AS (SELECT p.n, p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
             row_number() OVER (PARTITION BY p.n ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
      FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM w WHERE place = 1
"""
_OP7 = r"""
WITH s(sid, sentence) AS (VALUES {sentences}),
cut AS (SELECT doc_id, regexp_split_to_array(regexp_replace(coalesce(text, ''), '[.!?;:]+([ \t\r\n]|$)', chr(10), 'g'), '\n') AS parts FROM documents),
part AS (SELECT doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) AS pos FROM cut),
hit AS (SELECT doc_id, pos, sid FROM part JOIN s ON trim(regexp_replace(lower(raw), '[^a-z0-9]+', ' ', 'g')) = sentence),
seq AS (SELECT doc_id, count(*) AS n, ' ' || string_agg(sid, '  ' ORDER BY pos) || ' ' AS ids FROM hit GROUP BY doc_id),
rule(ids, license) AS (VALUES {rules}),
got AS (SELECT DISTINCT doc_id, license FROM (SELECT doc_id, unnest(regexp_extract_all(ids, '{pattern}')) AS ids FROM seq) JOIN rule USING (ids))
SELECT d.doc_id, coalesce(seq.n, 0) AS n_sentences, coalesce(l.licenses, '') AS licenses
FROM documents d LEFT JOIN seq USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS licenses FROM got GROUP BY doc_id) l USING (doc_id)
"""


def _licence_sql() -> str:
    ordered = sorted(license_scan.RULES, key=lambda r: (-len(r[2]), r[0]))
    run = lambda seq: " " + "  ".join(seq) + " "
    return _OP7.format(
        sentences=", ".join(f"('{k}', '{v}')" for k, v in license_scan.SENTENCES.items()),
        rules=", ".join(f"('{run(s)}', '{lic}')" for _, lic, s in ordered), pattern="|".join(run(s) for _, _, s in ordered),
    )


_FINE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"
_OP8 = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE {_FINE}),
w AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM w a JOIN w b ON a.vec_id <> b.vec_id WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.95),
c(node, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.v, c.root FROM c JOIN l ON l.u = c.node WHERE c.root < l.v),
m AS (SELECT node, min(root) AS component_id FROM c GROUP BY node),
k AS (SELECT u, count(*) AS n FROM l GROUP BY u)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, m.component_id, e.vec_id = m.component_id AS kept
FROM embeddings e JOIN m ON m.node = e.vec_id LEFT JOIN k ON k.u = e.vec_id
"""


_OP10 = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
i AS (SELECT doc_id, words, CAST(unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS BIGINT) AS k FROM w WHERE len(words) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(words[k : k + 3], ' ') AS shingle FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM o JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * common >= 80 * (x.n + y.n - common)),
c(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.v, c.root FROM c JOIN l ON l.u = c.node WHERE c.root < l.v),
m AS (SELECT node, min(root) AS component_id FROM c GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept FROM documents d JOIN m ON m.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


_OP11 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
t AS (SELECT *, list_transform(regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+'), lambda x: length(x)) AS sizes,
      CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT doc_id, text, len(sizes) AS n, sizes, least(h1 % (len(sizes) + 1), h2 % (len(sizes) + 1)) AS a, greatest(h1 % (len(sizes) + 1), h2 % (len(sizes) + 1)) AS b,
      CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT doc_id, text, n, form, CAST(coalesce(list_sum(sizes[1 : a]), 0) AS BIGINT) AS x, CAST(coalesce(list_sum(sizes[1 : b]), 0) AS BIGINT) AS y FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN text
      WHEN 'psm' THEN '<P>' || substr(text, 1, x) || '<S>' || substr(text, y + 1) || '<M>' || substr(text, x + 1, y - x)
      ELSE '<S>' || substr(text, y + 1) || '<P>' || substr(text, 1, x) || '<M>' || substr(text, x + 1, y - x) END AS output FROM p)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars, CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
       sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM o
"""

_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_OP12 = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
h AS (SELECT doc_id, len(terms) AS n, terms FROM d WHERE len(terms) > 0),
c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS length FROM h),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM h) SEMI JOIN q USING (term) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term),
g AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // length))) AS gain FROM p, c),
s AS (SELECT item_id, doc_id, CAST(sum(w * gain) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN g USING (term) GROUP BY ALL HAVING sum(w * gain) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""

_OP13 = """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT doc_id, pos, line, r.key IS NOT NULL AND doc_id <> top AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INTEGER)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id
"""


def _chat_sql() -> str:
    import re

    text = "coalesce(text, '')"
    any_ = "|".join(re.escape(c).replace("/", "/") for c in chat_format.CONTROLS).replace("'", "''")
    escaped = rf"length(regexp_replace({text}, '(\\*({any_}))', '\\\1', 'g'))"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || {text} || chr(10), '' ORDER BY turn, role, {text})) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length({text}) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg({text}, '' ORDER BY turn, role, {text}) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len(chat_format.START)} + length(url_encode(role)) + 1 + {escaped} + {len(chat_format.TAIL)}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


ORACLE_SQL = {
    "op6_url_filter": _OP6.format(rules=", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)),
    "op7_license_scan": _licence_sql(),
    "op8_embedding_dedup": _OP8,
    "op9_chat_format": _chat_sql(),
    "op10_minhash_dedup": _OP10,
    "op11_fill_in_middle": _OP11,
    "op12_lexical_search": _OP12,
    "op13_line_dedup": _OP13,
}
