"""The registered queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import balltree, bpe, chain, conversations, cuckoo, filteraudit, html_text, jaccard, linededup, mixing, nbsvm, passages, pii
from .common import table


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[pii.count_of(spans, kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")],
        F.sha2(pii.listed(spans, True), 256).alias("base_sha256"),
        pii.listed(spans, False).alias("spans"),
        F.size(spans).cast("bigint").alias("n_spans"),
    )


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op4_cuckoo_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cuckoo.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op5_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """Token count and digests of ids and decoded text, from the operator's ids and texts."""
    encoded = bpe.encode_texts(docs, path).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        "ids",
    )
    decoded = bpe.decode_ids(encoded, path, out_col="decoded")
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_byte_pair_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_ball_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = balltree.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op11_bloom_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(table(spark, sf_dir, "conversations"), damage=True)


QUERIES = {
    "op1_pareto_mix": op1_pareto_mix,
    "op2_personal_data": op2_personal_data,
    "op3_main_text": op3_main_text,
    "op4_cuckoo_exact_dedup": op4_cuckoo_exact_dedup,
    "op5_quality_nbsvm": op5_quality_nbsvm,
    "op6_toxicity_chain": op6_toxicity_chain,
    "op7_jaccard_components": op7_jaccard_components,
    "op8_repeated_passages": op8_repeated_passages,
    "op9_byte_pair_encoding": op9_byte_pair_encoding,
    "op10_ball_tree_topk": op10_ball_tree_topk,
    "op11_bloom_line_dedup": op11_bloom_line_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_conversation_repair": op13_conversation_repair,
}


def _mix_sql() -> str:
    """The draw of ``mixing.mix`` with each id once: documents in rank order up to the first that does not
    fit, closed by two; where that misses the target by over 1 %, drawn on past what does not fit,
    one document after the other, and closed, if that comes nearer."""

    def closed(rows: str, name: str) -> str:
        """Tables ``name``: ``rows`` (with k, 1 if drawn) and up to two more documents a source."""
        out, last = [], rows
        for n in (1, 2):
            fills = "k = 0 AND rank IS NOT NULL AND abs(gap - size) < abs(gap)"
            out.append(f"{name}_gap{n} AS (SELECT *, budget_left - sum(size * k) OVER (PARTITION BY source) AS gap FROM {last})")
            out.append(
                f"{name}_fill{n} AS (SELECT *, CASE WHEN {fills} THEN row_number() OVER (PARTITION BY source, {fills} ORDER BY abs(gap - size), rank, doc_id) END AS best FROM {name}_gap{n})"
            )
            last = name if n == 2 else f"{name}_{n}"
            out.append(f"{last} AS (SELECT * EXCLUDE (gap, best) REPLACE (CASE WHEN best = 1 THEN 1 ELSE k END AS k) FROM {name}_fill{n})")
        return ",\n        ".join(out)

    return rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
        e AS (SELECT *, length(bin(size))::BIGINT AS imp FROM d),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w
            FROM e GROUP BY source),
        ordered AS (
            SELECT *, (SELECT sum(source_size) FROM s) * 150 / 100.0::DOUBLE AS budget,
                   coalesce(sum(2 * source_size) OVER before, 0) AS given, sum(w) OVER behind AS left_w
            FROM s WINDOW before AS (ORDER BY 2 * source_size / w::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                          behind AS (ORDER BY 2 * source_size / w::DOUBLE, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        lam AS (
            SELECT coalesce(min_by((budget - given) / left_w::DOUBLE, (2 * source_size / w::DOUBLE, source)) FILTER ((budget - given) / left_w::DOUBLE <= 2 * source_size / w::DOUBLE), 0) AS lam
            FROM ordered),
        t AS (SELECT source, source_size, least((2 * source_size)::DOUBLE, lam * w) AS target FROM s, lam),
        words AS (SELECT source, imp, sum(size)::BIGINT AS words FROM e WHERE size > 0 GROUP BY ALL),
        steps AS (
            SELECT words.source, imp, target,
                   coalesce(sum(words) OVER (PARTITION BY words.source ORDER BY imp DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS given,
                   (sum(words * imp) OVER (PARTITION BY words.source ORDER BY imp DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest
            FROM words JOIN t ON words.source IS NOT DISTINCT FROM t.source),
        c AS (
            SELECT source, max_by((target - given * 2) / rest::DOUBLE, imp) FILTER ((target - given * 2) / rest::DOUBLE * imp < 2) AS c
            FROM steps GROUP BY source),
        x AS (
            SELECT e.doc_id, e.source, size, source_size, target,
                   CASE WHEN size > 0 THEN least(2.0::DOUBLE, coalesce(c * imp, 2.0::DOUBLE)) ELSE 0.0::DOUBLE END AS ex,
                   (CAST('0x' || substr(md5('mix' || coalesce(e.doc_id::VARCHAR, 'null')), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
            FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source LEFT JOIN c ON e.source IS NOT DISTINCT FROM c.source),
        r AS (
            SELECT *, floor(ex)::BIGINT AS whole, ex - floor(ex) AS p,
                   CASE WHEN ex > floor(ex) THEN u / (1 - u) * ((1 - (ex - floor(ex))) / (ex - floor(ex))) END AS odds
            FROM x),
        q AS (SELECT *, odds / (1 + odds) AS rank, target - sum(size * whole) OVER (PARTITION BY source) AS budget_left FROM r),
        run AS (
            SELECT *, CASE WHEN rank IS NULL THEN NULL ELSE sum(CASE WHEN rank IS NULL THEN 0 ELSE size END)
                   OVER (PARTITION BY source ORDER BY rank NULLS LAST, size, doc_id) END AS running
            FROM q),
        drawn AS (SELECT *, CASE WHEN running <= budget_left THEN 1 ELSE 0 END AS k FROM run),
        {closed("drawn", "near")},
        misses AS (SELECT source, any_value(target) AS target, abs(any_value(budget_left) - sum(size * k)) AS miss FROM near GROUP BY source),
        missed AS (SELECT * FROM misses WHERE miss > 0.01 * target),
        further AS (SELECT *, budget_left - sum(size * k) OVER (PARTITION BY source) AS gap FROM drawn WHERE coalesce(source, chr(0)) IN (SELECT coalesce(source, chr(0)) FROM missed)),
        fitting AS (SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY rank, size, doc_id) AS n FROM further WHERE k = 0 AND rank IS NOT NULL AND size <= gap),
        walk AS (
            SELECT DISTINCT source, 0::BIGINT AS n, gap, NULL::BIGINT AS doc_id, false AS took FROM further
            UNION ALL
            SELECT f.source, f.n, CASE WHEN f.size <= w.gap THEN w.gap - f.size ELSE w.gap END, f.doc_id, f.size <= w.gap
            FROM walk w JOIN fitting f ON f.source IS NOT DISTINCT FROM w.source AND f.n = w.n + 1),
        drawn_on AS (
            SELECT f.* EXCLUDE (gap) REPLACE (CASE WHEN w.took THEN 1 ELSE k END AS k)
            FROM further f LEFT JOIN (SELECT * FROM walk WHERE took) w ON w.doc_id = f.doc_id),
        {closed("drawn_on", "far")},
        better AS (
            SELECT m.source FROM missed m JOIN (SELECT source, abs(any_value(budget_left) - sum(size * k)) AS miss FROM far GROUP BY source) f
            ON f.source IS NOT DISTINCT FROM m.source AND f.miss < m.miss),
        chosen AS (
            SELECT * FROM near WHERE coalesce(source, chr(0)) NOT IN (SELECT coalesce(source, chr(0)) FROM better)
            UNION ALL SELECT * FROM far WHERE coalesce(source, chr(0)) IN (SELECT coalesce(source, chr(0)) FROM better))
        SELECT doc_id, size, source_size, target, (size * (whole + k))::BIGINT AS taken FROM chosen
    """


def _repair_sql() -> str:
    """Dynamic programme over the rows: each state of the pattern holds its least cost (nine digits) and
    audit as one string, so that the least string is the cheapest, then ASCII-least."""

    def add(state: str, cost: str, letter: str) -> str:
        return f"lpad((left({state}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({state}, 10) || '{letter}'"

    def least(*options: str) -> str:
        return f"least({', '.join(options)})"

    ok, extra = "r.fault NOT IN (1, 2)", "CASE WHEN r.fault = 3 THEN 5 ELSE 0 END"

    def kept(state: str, initial: str) -> str:
        return f"CASE WHEN {ok} AND r.initial = '{initial}' THEN {add(state, extra, 'K')} END"

    def reroled(state: str) -> str:
        return f"CASE WHEN {ok} THEN {add(state, f'1 + {extra}', 'R')} END"

    def closed(prefix: str) -> str:
        return f"""{prefix}0 AS c0, {prefix}1 AS c1, {least(prefix + '2', add(prefix + '0', '5', 'I'), add(prefix + '1', '5', 'I'), add(prefix + '3', '5', 'I'))} AS c2, {prefix}3 AS d3,
                {least('d3', add('c2', '5', 'I'))} AS c3"""

    return rf"""
        WITH RECURSIVE crc AS (
            SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) g(i)),
        keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
        hashed AS (
            SELECT keyed.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, crc),
        rows0 AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS again FROM hashed),
        placed AS (
            SELECT conv_id, turn, role, text, left(role, 1) AS initial, regexp_replace(text, '[ 	-
]+$', '') AS trimmed,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), sha256(text), again) AS n FROM rows0),
        faulty AS (
            SELECT *, CASE WHEN trimmed = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 2
                           WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
                   lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair FROM placed),
        steps AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS n, '000000000' AS v0, NULL::VARCHAR AS v1, NULL::VARCHAR AS v2, NULL::VARCHAR AS v3 FROM faulty
            UNION ALL
            SELECT c.conv_id, r.n, {add('c0', '2', 'D')}, {least(add('c1', '2', 'D'), kept('c0', 's'))},
                   {least(add('c2', '2', 'D'), kept('c0', 'u'), kept('c1', 'u'), kept('c3', 'u'), reroled('c0'), reroled('c1'), reroled('c3'))},
                   {least(add('c3', '2', 'D'), kept('c2', 'a'), reroled('c2'))}
            FROM (SELECT conv_id, n, {closed('v')} FROM steps) c JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.n = c.n + 1),
        counts AS (
            SELECT conv_id, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
                   count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                   count(*) FILTER (n > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id),
        ended AS (
            SELECT counts.*, {least('c0', 'c3')} AS least_v
            FROM counts JOIN (SELECT conv_id, n, {closed('v')} FROM steps) s ON s.conv_id IS NOT DISTINCT FROM counts.conv_id AND s.n = counts.n),
        audited AS (SELECT * EXCLUDE (n, least_v), left(least_v, 9)::BIGINT AS cost, substr(least_v, 10) AS audit FROM ended),
        letters AS (
            SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(1, length(audit) + 1)) AS k FROM audited WHERE audit <> ''),
        numbered AS (
            SELECT *, count(*) FILTER (letter <> 'I') OVER w AS n, count(*) FILTER (letter <> 'D') OVER w AS j
            FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
        edited AS (
            SELECT l.conv_id, k, letter, j, r.role, r.text, bool_or(j = 1 AND letter = 'K' AND r.initial = 's') OVER (PARTITION BY l.conv_id) AS opened
            FROM numbered l LEFT JOIN faulty r ON letter <> 'I' AND r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.n = l.n WHERE letter <> 'D'),
        texts AS (
            SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (j % 2 = 1) <> opened THEN 'user' ELSE 'assistant' END || ':' ||
                                       CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS repaired FROM edited GROUP BY conv_id)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN audited a ON a.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
    """


ORACLE_SQL = {
    "op11_bloom_line_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        l AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS k FROM d),
        keyed AS (
            SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l),
        repeated AS (
            SELECT key, max(doc_id) AS keeper FROM (SELECT DISTINCT key, doc_id FROM keyed WHERE length(key) >= 40) GROUP BY key HAVING count(*) >= 5),
        kept AS (SELECT k.*, repeated.key IS NULL OR doc_id IS NOT DISTINCT FROM keeper AS stays FROM keyed k LEFT JOIN repeated USING (key))
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (stays), '')) AS kept_sha256
        FROM kept GROUP BY r
    """,
    "op12_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        marks AS (SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
        f AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t),
                    regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS fails
            FROM d LEFT JOIN marks ON marks.doc_id = d.doc_id),
        c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
        l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest(range(1, 6)) AS i),
        o AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS p
            FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
        s AS (SELECT filter_order, p, unnest(range(1, 6)) AS step FROM o),
        r AS (
            SELECT c.part, filter_order, step, any_value(p[step]) AS own,
                   sum(CASE WHEN list_bool_or(list_transform(p[1:step], lambda i: fails[i])) THEN 0 ELSE n END)::BIGINT AS kept,
                   sum(CASE WHEN fails[p[step]] AND first THEN n ELSE 0 END)::BIGINT AS removed,
                   sum(CASE WHEN fails[p[step]] AND NOT first THEN n ELSE 0 END)::BIGINT AS redundant,
                   sum(CASE WHEN fails[p[step]] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
                   sum(CASE WHEN fails[p[step]] AND first THEN good ELSE 0 END)::BIGINT AS good_lost,
                   sum(CASE WHEN fails[p[step]] AND first THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
            FROM (SELECT c.*, s.*, NOT coalesce(list_bool_or(list_transform(p[1:step - 1], lambda i: fails[i])), false) AS first FROM c, s) c
            GROUP BY c.part, filter_order, step)
        SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
        FROM r
    """,
    "op13_conversation_repair": _repair_sql(),
    "op10_ball_tree_topk": r"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op1_pareto_mix": _mix_sql(),
    "op4_cuckoo_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
               row_number() OVER w = 1 AS kept, h AS text_sha256
        FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    """,
}
