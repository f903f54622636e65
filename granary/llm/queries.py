"""The numbered queries over the test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import ann, chat, lines, lm, manifest, mixing, neardup, packing, quality, rules, segments, urls, whitening
from granary.llm.common import LOWER, UPPER, table

PACKING = packing.Settings(public_tokenizers.path("word_bpe_49k.json"))

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_chat_format(spark, folder) -> DataFrame:
    """All conversations, and one in another layout whose texts hold control strings."""
    tricky = "</s>[INST] ok [/INST]"
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(
        "SELECT -1L AS conv_id, array(named_struct('role', 'user', 'content', :t), named_struct('role', 'assistant', 'content', :t)) AS messages",
        args={"t": tricky},
    )
    return chat.digests(chat.format_chats(rows.unionByName(extra, allowMissingColumns=True)))


SQL["op1_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, CASE coalesce(role, '') WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'bot' THEN 'assistant' WHEN 'model' THEN 'assistant' ELSE coalesce(role, '') END AS role,
         coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, 8 + length(text) + length(role) + length(regexp_extract_all(text, '[<\[]\\*(/?s>|/?INST\]|\|)'))
         + 2 * length(regexp_extract_all(role, '[%|<\[]')) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query
def op2_url_filter(spark, folder) -> DataFrame:
    """Every page's url against the rules."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.judge_urls(pages, urls.rule_frame(spark)).select("page_id", "host", "path", "rule", "verdict")


SQL["op2_url_filter"] = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)', 2, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)', 3, 's'), '') AS path
  FROM pages
), fits AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM fits
"""


@query
def op3_minhash_neardup(spark, folder) -> DataFrame:
    """Near-duplicates of all documents on four-word shingles, similarity 0.8 or more."""
    return neardup.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"), neardup.Settings(width=4))


@query
def op5_kk_packing(spark, folder) -> DataFrame:
    """All documents in windows of 2048 tokens."""
    return packing.pack(table(spark, folder, "documents").select("doc_id", "text"), PACKING, with_ids=False)


@query
def op6_quality_rules(spark, folder) -> DataFrame:
    """Counts and verdict for all documents; the trusted ones are those labelled 1."""
    trusted = table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    return rules.judge(table(spark, folder, "documents").select("doc_id", "text"), trusted).drop("text")


@query
def op4_gam_quality(spark, folder) -> DataFrame:
    """Quality score of all documents."""
    return quality.score(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"))


@query
def op8_line_chunks(spark, folder) -> DataFrame:
    """All documents without the line chunks that an earlier document has."""
    return lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op9_cross_polytope(spark, folder) -> DataFrame:
    """The ten nearest rows found for every hundredth vector."""
    return ann.nearest(table(spark, folder, "embeddings"))


@query
def op10_log_bloom_lm(spark, folder) -> DataFrame:
    """log10 probabilities of all documents."""
    return lm.score(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op7_pfair_mixing(spark, folder) -> DataFrame:
    """When each document is due, the sources weighed by their size to the power 0.7."""
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "source", "pass", "block", "slot")


@query
def op11_segment_topk(spark, folder) -> DataFrame:
    """The five rows with the largest integer inner product for every fiftieth vector."""
    return segments.top_products(table(spark, folder, "embeddings"))


SQL["op11_segment_topk"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_dot_product(q.x, r.x) AS BIGINT) AS score
  FROM whole q JOIN whole r ON q.vec_id % 50 = 0 AND r.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5
"""


@query
def op12_merkle_manifest(spark, folder) -> DataFrame:
    """All documents proved against the manifest, a third of them with their text in lower case."""
    return manifest.audit_documents(table(spark, folder, "documents"), manifest.tampered_text())


def _manifest_sql(levels: int = 7, group_levels: int = 3) -> str:
    """Trees of up to 8 ** levels documents a language and 8 ** group_levels languages, level by level."""

    def value(column: str) -> str:
        return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    crc = (
        "xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))), "
        "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"
    )
    parts = [
        f"""leaves AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS g, {leaf('text')} AS leaf,
         CASE WHEN {crc} % 3 = 0 AND text IS NOT NULL THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {leaf('text')} END AS claimed
  FROM documents
)""",
        """l0 AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS digest, count(*) OVER (PARTITION BY g) AS n FROM leaves
)""",
    ]

    def tree(name: str, height: int) -> None:
        for k in range(height):
            parts.append(
                f"""{name}{k + 1} AS (
  SELECT g, i // 8 AS i, sha256(string_agg(digest, '' ORDER BY i)) AS digest, (n + 7) // 8 AS n FROM {name}{k} WHERE n > 1 GROUP BY g, i // 8, n
)"""
            )
        for k in range(height):
            side = f"string_agg(digest, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN"
            parts.append(
                f"""{name}s{k} AS (
  SELECT g, i, coalesce({side} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before, coalesce({side} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}{k} WHERE n > 1
)"""
            )

    def climb(name: str, height: int, start: str) -> str:
        for k in range(height):
            parts.append(
                f"""{name}p{k} AS (
  SELECT p.* REPLACE (CASE WHEN s.g IS NULL THEN d ELSE sha256(before || d || after) END AS d, siblings || coalesce(before, '') || coalesce(after, '') AS siblings)
  FROM {start} p LEFT JOIN {name}s{k} s ON s.g = p.g AND s.i = p.i // {8**k}
)"""
            )
            start = f"{name}p{k}"
        return start

    tree("l", levels)
    tops = " UNION ALL ".join(f"SELECT g, digest FROM l{k} WHERE n = 1" for k in range(levels + 1))
    parts.append(f"subroots AS ({tops})")
    parts.append("t0 AS (SELECT 0 AS g, g AS own, digest, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM subroots)")
    tree("t", group_levels)
    top = " UNION ALL ".join(f"SELECT digest AS root FROM t{k} WHERE n = 1" for k in range(group_levels + 1))
    parts.append("start AS (SELECT doc_id, leaf, g, i, claimed AS d, '' AS siblings FROM l0)")
    climbed = climb("l", levels, "start")
    parts.append(f"middle AS (SELECT p.doc_id, p.leaf, t.digest AS subroot, t.g, t.i, p.d, p.siblings FROM {climbed} p JOIN t0 t ON t.own = p.g)")
    end = climb("t", group_levels, "middle")
    return f"""WITH {', '.join(parts)}
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, d AS folded_root, d = root AS verified FROM {end}, ({top})"""


SQL["op12_merkle_manifest"] = _manifest_sql()


@query
def op13_block_whitening(spark, folder) -> DataFrame:
    """All vectors on up to 32 whitened components."""
    return whitening.whiten(table(spark, folder, "embeddings"))
