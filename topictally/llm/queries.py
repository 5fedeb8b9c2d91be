"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from topictally.llm import (
    bpe,
    chat,
    exact_dedup,
    html_extract,
    jaccard_join,
    language_id,
    merkle,
    ngram_lm,
    packing,
    prefix_trie,
    quality,
    secrets,
    top_k,
)
from topictally.session import scratch_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def _vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op2_ngram_lm(spark, sf_dir):
    held_out = F.coalesce(_remainder(7) == 2, F.lit(False))
    scored = ngram_lm.score_corpus(_table(spark, sf_dir, "documents"), ~held_out)
    return scored.withColumn("held_out", ~F.col("trained")).drop("trained")


def op3_bpe_code(spark, sf_dir):
    coded = bpe.code_documents(_table(spark, sf_dir, "documents"), _vocabulary())
    told = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(told.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def _remainder(modulus: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op5_language_id(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False))
    model = language_id.train(documents.filter(~held_out))
    return language_id.predict(documents, model, extra=(held_out.alias("held_out"),))


def op6_html_extract(spark, sf_dir):
    texts = html_extract.extract(_table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op7_quality_rules(spark, sf_dir):
    judged = quality.judge_documents(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


_CLASHING = "</s>[INST] ok [/INST]"


def op8_chat_format(spark, sf_dir):
    """All conversations and one that holds the template's own marks."""
    clash = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_CLASHING).alias("text"),
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_conversations(rows.union(clash))
    # The spans and the text are read back; nothing below looks at the source.
    read = chat.parse_conversations(formatted, extra=("formatted",))
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(told, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op9_secret_scan(spark, sf_dir):
    found = secrets.scan(_table(spark, sf_dir, "documents"), scratch_folder(spark, "secret-ledger"))

    def of(*rules):
        return F.filter("spans", lambda s: s["rule"].isin(*rules))

    return found.select(
        "doc_id",
        *(
            F.size(of(rule)).cast("bigint").alias(f"n_{rule}")
            for rule in ("assign", "access", "hex")
        ),
        F.sha2(secrets.joined(of("assign", "access", "hex")).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op10_best_fit_packing(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    pieces = packing.cut_documents(documents, _vocabulary(), capacity=1024, end=2)
    summed = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(summed, capacity=1024)


def op11_exact_top_k(spark, sf_dir):
    embeddings = _table(spark, sf_dir, "embeddings")
    return top_k.exact_top_k(embeddings, F.col("vec_id") % 20 == 0, k=20)


def op12_prefix_trie(spark, sf_dir):
    """The trie of all conversations after each got the first turns of its twenty's first one."""
    whole = prefix_trie.sequences(_table(spark, sf_dir, "conversations"))
    key = F.col("conv_id")
    shared = F.crc32(key.cast("string").cast("binary")) % 4
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(whole, key - key % 20, shared, most=3))


def op13_merkle_manifest(spark, sf_dir):
    """Leaves, roots and proofs; a seventh of the rows is shown with one character more than recorded."""
    told = F.col("n_chars").cast("decimal(38,0)")
    tampered = F.coalesce(_remainder(7) == 0, F.lit(False))
    shown = F.when(tampered, told + 1).otherwise(told)
    made = merkle.manifest(_table(spark, sf_dir, "documents"), presented={"n_chars": shown})

    def text(name: str):
        return F.lower(F.hex(name))

    return made.select(
        "doc_id",
        text("leaf").alias("leaf"),
        text("subroot").alias("subroot"),
        text("root").alias("root"),
        text("proof").alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = (
    op1_exact_dedup,
    op2_ngram_lm,
    op3_bpe_code,
    op4_jaccard_join,
    op5_language_id,
    op6_html_extract,
    op7_quality_rules,
    op8_chat_format,
    op9_secret_scan,
    op10_best_fit_packing,
    op11_exact_top_k,
    op12_prefix_trie,
    op13_merkle_manifest,
    pipeline,
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_DEDUP_SQL = r"""
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
    FROM documents)
SELECT doc_id, first(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
    row_number() OVER w = 1 AS kept, sha256(body) AS text_sha256
FROM n WINDOW w AS (PARTITION BY body ORDER BY points DESC, doc_id)
"""

#: ASCII letters only, as the operators lower them.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _jaccard_sql(table: str, width: int, percent: int) -> str:
    """Every pair of texts with a common shingle, counted, and the links followed to their ends."""
    shingle = " || ' ' || ".join(f"ws[i + {k}]" for k in range(width))
    return rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM {table}),
s AS (
    SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
        WHEN len(ws) < {width} THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - {width - 2}), lambda i: {shingle})) END AS g
    FROM w),
x AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
o AS (
    SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) AS n, count(*) AS o
    FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o WHERE 100 * o >= {percent} * (n - o)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (
    SELECT doc_id, doc_id AS root FROM w
    UNION SELECT e.b, r.root FROM r JOIN both_ways e ON e.a = r.doc_id)
SELECT doc_id, any_value(len(g)) AS n_shingles, min(root) AS component_id
FROM r JOIN s USING (doc_id) GROUP BY doc_id
"""


_CHAT_SQL = r"""
WITH c AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
    SELECT *, length(role) + length(text) + length('[INST] ') + length(' [/INST]') + length('</s>')
        + len(regexp_extract_all(text, '\[\\*INST\]|\[\\*/INST\]|<\\*/s>')) AS size
    FROM c)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(size)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


def _secret_sql() -> str:
    """Spans of each rule by cutting the text at its matches, then all of them joined."""
    cuts = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS place, '{r.name}' AS rule, {r.least} AS least, "
        f"string_split_regex(text, {_quoted(_re2(r))}) AS parts, "
        f"regexp_extract_all(text, {_quoted(_re2(r))}, 0) AS whole, "
        f"regexp_extract_all(text, {_quoted(_re2(r))}, {r.group}) AS counted FROM d"
        for i, r in enumerate(secrets.RULES)
    )
    named = "rule || ':' || (stop - length(w)) || ':' || stop"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cuts AS ({cuts}),
pieces AS (
    SELECT doc_id, place, rule, least, unnest(parts[1:len(whole)]) AS p, unnest(whole) AS w,
        unnest(counted) AS c, unnest(range(1, len(whole) + 1)) AS i
    FROM cuts WHERE len(whole) > 0),
spans AS (
    SELECT *, (sum(length(p) + length(w)) OVER (PARTITION BY doc_id, place ORDER BY i))::BIGINT AS stop
    FROM pieces),
found AS (
    SELECT doc_id,
        count(*) FILTER (rule = 'assign') AS n_assign,
        count(*) FILTER (rule = 'access') AS n_access,
        count(*) FILTER (rule = 'hex') AS n_hex,
        string_agg({named}, ',' ORDER BY stop - length(w), place) FILTER (place < 3) AS base,
        string_agg({named}, ',' ORDER BY stop - length(w), place) AS spans
    FROM spans WHERE length(c) >= least GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans
FROM d LEFT JOIN found USING (doc_id)
"""


def _re2(rule: secrets.Rule) -> str:
    """The rule's pattern where letters in either case are ASCII only."""
    words = "password|passwd|secret|token|api_?key"
    either = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)
    return rule.pattern.replace(f"(?i:({words}))", f"({either})")


#: For pages whose main text is their one article of headings and paragraphs.
_PAGES_SQL = r"""
WITH a AS (
    SELECT page_id, url, string_split_regex(
        replace(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '<br>', ' '),
        '</?(?:p|h1)>') AS parts
    FROM pages),
b AS (
    SELECT page_id, url, list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(
        replace(replace(replace(replace(regexp_replace(x, '</?b>', '', 'g'),
            '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)),
        '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts
    FROM a),
c AS (
    SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) AS text
    FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM c
"""


def _quality_sql() -> str:
    """Base features, both histograms of each text and language, and their nearest distances.

    A language's histograms count each distinct text that passes the base rules once.
    """
    rules = quality.Rules()
    kinds = {
        "lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "space": r"[ \x09\x0B-\x0D]",
        "line": r"\n", "stop": r"""[.,;:!?"'()-]""",
    }
    ascii_only = r"regexp_replace(text, '[^\x00-\x7F]', '', 'g')"
    counted = {k: f"len(regexp_extract_all(text, {_quoted(c)}))" for k, c in kinds.items()}
    counted["other"] = f"strlen(text) - length({ascii_only})"
    counted["symbol"] = f"length({ascii_only}) - (" + " + ".join(counted[k] for k in kinds) + ")"
    classes = " UNION ALL ".join(
        f"SELECT doc_id, lang, '{k}' AS x, {c} AS n FROM d" for k, c in counted.items()
    )
    strip = _quoted(quality.STRIPPED.decode())
    # Half the divergence of each bin to the middle; a bin that is empty on a side adds nothing there.
    bits = (
        "CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END"
        " + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END"
    )
    distance = f"sqrt(greatest(0, sum({bits}) / 2))"
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, lang, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
words AS (
    SELECT doc_id, lang, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
windows AS (
    SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i,
        unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i:i + 2])) AS g FROM w),
repeated AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range(0, 3) AS t(k) GROUP BY doc_id),
lines AS (
    SELECT doc_id, len(ls) - len(list_distinct(ls)) AS n FROM (
        SELECT doc_id, list_filter(string_split(text, chr(10)),
            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d)),
base AS (
    SELECT doc_id, len(ws) AS n_words,
        coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, lines.n AS n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words
    FROM w JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
classes AS ({classes}),
refs AS (
    SELECT min(doc_id) AS doc_id FROM d JOIN base USING (doc_id)
    WHERE lang IS NOT NULL AND n_words >= {rules.least_words}
        AND 100 * n_repeat_words <= {rules.repeat_percent} * n_words
    GROUP BY lang, text),
class_sums AS (SELECT lang, x, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q
    FROM classes SEMI JOIN refs USING (doc_id) GROUP BY lang, x),
class_far AS (
    SELECT doc_id, min(far) AS far FROM (
        SELECT doc_id, r.lang, {distance} AS far FROM (
            SELECT doc_id, x, n / sum(n) OVER (PARTITION BY doc_id) AS p FROM classes) c
        JOIN class_sums r USING (x) GROUP BY doc_id, r.lang) GROUP BY doc_id),
stems AS (
    SELECT doc_id, lang, translate(trim(word, {strip}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS x FROM words),
sums AS (SELECT lang, x, count(*) AS n, sum(count(*)) OVER (PARTITION BY lang) AS total
    FROM stems SEMI JOIN refs USING (doc_id) GROUP BY lang, x),
top AS (
    SELECT lang, x, n / total AS q FROM sums WHERE x <> ''
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, x) <= {rules.common_words}),
own AS (SELECT doc_id, x, count(*) AS n FROM stems GROUP BY doc_id, x),
shares AS (
    SELECT base.doc_id, top.lang, q, coalesce(own.n, 0) / n_words AS p
    FROM base JOIN top ON n_words > 0 LEFT JOIN own ON own.doc_id = base.doc_id AND own.x = top.x),
word_far AS (
    SELECT doc_id, min(far) AS far FROM (
        SELECT doc_id, lang, {distance} AS far FROM (
            SELECT doc_id, lang, p, q FROM shares UNION ALL
            SELECT doc_id, lang, greatest(0, 1 - sum(p)), greatest(0, 1 - sum(q))
            FROM shares GROUP BY doc_id, lang)
        GROUP BY doc_id, lang) GROUP BY doc_id),
judged AS (
    SELECT base.*, n_words < {rules.least_words}
            OR 100 * n_repeat_words > {rules.repeat_percent} * n_words AS base_failed,
        (n_words >= {rules.class_words} AND c.far > {rules.class_distance})
            OR (n_words >= {rules.word_words} AND t.far > {rules.word_distance}) AS diverges
    FROM base LEFT JOIN class_far c USING (doc_id) LEFT JOIN word_far t USING (doc_id))
SELECT * EXCLUDE (diverges), NOT base_failed AND NOT coalesce(diverges, false) AS kept FROM judged
"""


_TOP_K_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER w::INT AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
"""

#: crc32 by its polynomial, eight shifts a byte; DuckDB has no such function.
_CRC32 = """
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1),
        lambda i: ascii({0}[i])::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)),
        lambda r, k: xor(r >> 1, (r & 1) * 3988292384)))
"""


def _crc32_sql(number: str) -> str:
    """The unsigned crc32 of a whole number's decimal digits."""
    return f"xor({_CRC32.format(f'(({number})::VARCHAR)')}, 4294967295)"


def _trie_sql() -> str:
    """Each conversation's beginnings, grouped; subtrees by joining nodes with the beginnings below them."""
    return rf"""
WITH RECURSIVE t AS (
    SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
        len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS words
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (
    SELECT conv_id, list({{'id': id, 'words': words}} ORDER BY turn NULLS FIRST, id) AS own,
        ({_crc32_sql('conv_id')} % 4)::INT AS h
    FROM t GROUP BY conv_id),
r AS (
    SELECT c.conv_id, list_concat(coalesce(f.own[1:c.h], []), c.own[c.h + 1:]) AS turns
    FROM c LEFT JOIN c f ON f.conv_id = c.conv_id - c.conv_id % 20),
p AS (
    SELECT conv_id, d, len(turns) AS size, CASE WHEN d > 0 THEN turns[d].words ELSE 0 END AS words,
        sha256(array_to_string(list_transform(turns[1:d], lambda x: x.id), ',')) AS node,
        CASE WHEN d > 0 THEN
            sha256(array_to_string(list_transform(turns[1:d - 1], lambda x: x.id), ',')) END AS above
    FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)),
n AS (
    SELECT node, any_value(above) AS above, any_value(d) AS depth, min(conv_id) AS conv_id,
        count(*) AS n_convs, (count(*) - 1) * any_value(words) AS own,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256
    FROM p GROUP BY node),
k AS (SELECT above AS node, count(*) AS n_children FROM n WHERE above IS NOT NULL GROUP BY above),
s AS (
    SELECT node AS top, node, above, own FROM n
    UNION ALL SELECT s.top, n.node, n.above, n.own FROM s JOIN n ON n.above = s.node),
u AS (
    SELECT top AS node, sum(own)::BIGINT AS saved_tokens,
        count(*) FILTER (k.node IS NULL) AS n_leaves
    FROM s LEFT JOIN k ON k.node = s.node GROUP BY top)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
    u.n_leaves, u.saved_tokens, n.ends_sha256
FROM n JOIN u USING (node) LEFT JOIN k USING (node) LEFT JOIN n m ON m.node = n.above
"""


def _merkle_sql() -> str:
    """Levels by pairing neighbours, then proofs and folding a level at a time."""

    def leaf(n_chars: str) -> str:
        fields = ("doc_id", "source", "lang", n_chars, "text")
        told = (f"coalesce(strlen(({f})::VARCHAR) || ':' || ({f})::VARCHAR, '-')" for f in fields)
        return f"sha256({' || '.join(told)})"

    shown = f"CASE WHEN {_crc32_sql('doc_id')} % 7 = 0 THEN n_chars + 1 ELSE n_chars END"

    def levels(leaves: str) -> str:
        return f"""
    SELECT tree, 0 AS level, i, h, count(*) OVER (PARTITION BY tree) AS n FROM ({leaves})
    UNION ALL
    SELECT tree, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2
    FROM {{0}} WHERE n > 1 GROUP BY tree, level, i // 2"""

    def walk(name: str, nodes: str, start: str) -> str:
        """Each document's way up: the digests beside it, and what its shown leaf folds to."""
        return f"""
{name} AS (
    {start}
    UNION ALL
    SELECT w.row, w.tree, w.level + 1, w.i // 2, w.proof || coalesce(b.h, ''),
        sha256(CASE WHEN w.i % 2 = 0 THEN w.folded || coalesce(b.h, '') ELSE b.h || w.folded END)
    FROM {name} w JOIN {nodes} x ON x.tree = w.tree AND x.level = w.level AND x.i = w.i AND x.n > 1
    LEFT JOIN {nodes} b ON b.tree = w.tree AND b.level = w.level AND b.i = xor(w.i, 1))"""

    inner = "SELECT tree, i, leaf AS h FROM d"
    outer = "SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, h FROM nodes WHERE n = 1"
    first = "SELECT row, tree, 0 AS level, i, '' AS proof, shown AS folded FROM d"
    second = """SELECT w.row, '' AS tree, 0 AS level, t.i, w.proof, w.folded FROM up w
        JOIN (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS i FROM nodes WHERE n = 1) t USING (tree)
        JOIN nodes x ON x.tree = w.tree AND x.level = w.level AND x.n = 1"""
    return f"""
WITH RECURSIVE l AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf('n_chars')} AS leaf, {leaf(shown)} AS shown
    FROM documents),
d AS (
    SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS row,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l),
nodes AS ({levels(inner).format('nodes')}),
tops AS ({levels(outer).format('tops')}),
{walk('up', 'nodes', first)},
{walk('over_all', 'tops', second)}
SELECT d.doc_id, d.leaf, s.h AS subroot, r.h AS root, sha256(w.proof) AS proof_sha256,
    w.folded AS folded_root, w.folded = r.h AS verified
FROM d JOIN nodes s ON s.tree = d.tree AND s.n = 1
JOIN (SELECT * FROM tops WHERE n = 1) r ON true
JOIN over_all w ON w.row = d.row AND w.level = r.level
"""


SQL = {
    "op1_exact_dedup": _DEDUP_SQL,
    "op4_jaccard_join": _jaccard_sql("documents", 4, 85),
    "op6_html_extract": _PAGES_SQL,
    "op7_quality_rules": _quality_sql(),
    "op8_chat_format": _CHAT_SQL,
    "op9_secret_scan": _secret_sql(),
    "op11_exact_top_k": _TOP_K_SQL,
    "op12_prefix_trie": _trie_sql(),
    "op13_merkle_manifest": _merkle_sql(),
}


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    whole = corpus_pipeline.ORACLE_SQL
    return SQL | ({"pipeline": whole} if whole else {})
