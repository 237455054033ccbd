"""The registered queries of this package, with check SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import bpe, chat, chunks, crf, cube, licenses, mil, ranked, rules, simhash, tiling, trie, warc
from ledgerloom.plans.registry import register, table
from ledgerloom.session import written_table

WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def turns_with_controls(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """All conversations, and one whose texts are control strings."""
    said = F.lit("</s>[INST] ok [/INST]")
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    extra = spark.range(0, 2, 1, 1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text")
    )
    return turns.select("conv_id", "turn", "role", "text").unionByName(extra)


@register(
    "op1_chat_format",
    r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), escaped AS (
        SELECT *,
            regexp_replace(
                regexp_replace(
                    regexp_replace(
                        replace(replace(replace(replace(text, '\', '\\'), '<|im_start|>', '<\|im_start|>'),
                            '<|im_sep|>', '<\|im_sep|>'), '<|im_part|>', '<\|im_part|>'),
                        '<(\|im_end\|>|\|endoftext\|>)', '<\\\1', 'g'),
                    '<(/?s>|<SYS>>|</SYS>>)', '<\\\1', 'g'),
                '\[(/?INST\])', '[\\\1', 'g') AS safe,
            coalesce(lag(role) OVER w <> role, true) AS opens,
            coalesce(lead(role) OVER w <> role, true) AS closes
        FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
    )
    SELECT conv_id,
        count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        sum(length(safe) + CASE WHEN opens THEN 22 + length(role) ELSE 11 END + CASE WHEN closes THEN 10 ELSE 0 END)::BIGINT
            AS formatted_chars
    FROM escaped GROUP BY conv_id
    """,
)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = chat.format_conversations(turns_with_controls(spark, table(spark, sf_dir, "conversations")))
    read = formatted.select(
        "conv_id",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.learnt_text(F.col("segments")).alias("learnt"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@register("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@register("op3_benchmark_tiles")
def op3_benchmark_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_ids", "coverage")


@register("op4_quality_lines")
def op4_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op5_mixture")
def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = cube.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@register("op6_licenses")
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "license", "coverage", "begin", "end", F.size("spans").alias("n_spans"))


@register("op7_line_chunks")
def op7_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = chunks.remove_repeated(table(spark, sf_dir, "documents"), counts=True, runs=True)
    return kept.select(
        "doc_id",
        "removed_lines",
        "removed_chunks",
        F.char_length("text").cast("long").alias("kept_chars"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


@register(
    "op8_warc",
    """
    WITH p AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
    ), o AS (
        SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS owner FROM p
    )
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
        translate(
            to_base(('0x' || substr(h, 1, 10))::BIGINT, 32, 8) || to_base(('0x' || substr(h, 11, 10))::BIGINT, 32, 8)
            || to_base(('0x' || substr(h, 21, 10))::BIGINT, 32, 8) || to_base(('0x' || substr(h, 31, 10))::BIGINT, 32, 8),
            '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
        CASE WHEN owner = page_id OR owner IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN owner <> page_id THEN owner END AS refers_to
    FROM o
    """,
)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_archives(table(spark, sf_dir, "pages"))
    read = warc.read_chunks(files, with_payload=False).where("last")
    return read.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


@register(
    "op9_quality_rules",
    rf"""
    WITH words AS (
        SELECT doc_id, coalesce(text, '') AS text, {WORDS_SQL} AS w,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
        FROM documents
    ), windows AS (
        SELECT doc_id, i, w[i:i + 2] AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
    ), twice AS (
        SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1
    ), covered AS (
        SELECT doc_id, count(DISTINCT i + d) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY doc_id
    ), m AS (
        SELECT words.doc_id, len(w)::BIGINT AS n_words,
            length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
            (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
            (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
            coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
            length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
            length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters
        FROM words LEFT JOIN covered USING (doc_id)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
        NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 10 * n_upper > 4 * n_letters
             OR word_chars < 2 * n_words OR word_chars > 25 * n_words) AS kept
    FROM m
    """,
)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        *("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        (~rules.passes("fail_bits", rules.BASE_POLICY)).alias("base_failed"),
        rules.passes("fail_bits").alias("kept"),
    )


@register("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mil.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"))


def byte_vocabulary() -> str:
    """The byte-level vocabulary of 50,257 tokens."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register("op11_byte_bpe")
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = byte_vocabulary()
    read = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return read.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """Numbered turns, the first few of each conversation taken from one that twenty share.

    Of conversation c the first h turns come from conversation c - c % 20, with
    h the CRC-32 of its decimal id modulo 4; its own turns follow from the h-th on.
    """
    most, spacing = 3, 20
    heads = turns.where(f"pos < {most} AND conv_id % {spacing} = 0").groupBy(F.col("conv_id").alias("base"))
    heads = heads.agg(F.collect_list(F.struct("pos", "digest", "words")).alias("heads"))
    wanted = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    convs = turns.where("pos = 0").select("conv_id", (F.col("conv_id") - F.col("conv_id") % spacing).alias("base"), wanted.alias("h"))
    begun = convs.join(heads, "base").select("conv_id", "h", F.explode("heads").alias("t")).where("t.pos < h")
    own = turns.withColumn("h", wanted).where("pos >= h")
    return begun.select("conv_id", "t.pos", "t.digest", "t.words").unionByName(
        own.select("conv_id", (F.col("pos") + most).alias("pos"), "digest", "words")
    )


@register(
    "op12_prefix_trie",
    r"""
    WITH numbered AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
        FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (
        SELECT conv_id, conv_id - conv_id % 20 AS base,
            xor(4294967295, list_reduce(
                list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                lambda crc, byte: list_reduce(range(0, 8),
                    lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(crc, byte)),
                4294967295::BIGINT)) % 4 AS h
        FROM (SELECT DISTINCT conv_id FROM numbered)
    ), rebuilt AS (
        SELECT c.conv_id, pos, role, text FROM convs c JOIN numbered n ON n.conv_id = c.base AND n.pos < c.h
        UNION ALL
        SELECT c.conv_id, pos + 4, role, text FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.pos >= c.h
    ), walks AS (
        SELECT conv_id, row_number() OVER w AS depth, sha256(list(sha256(length(role) || ':' || role || text)) OVER w::VARCHAR) AS node,
            len(regexp_extract_all(text, '[^ 	-
]+')) AS words, lead(pos) OVER w IS NULL AS ends
        FROM rebuilt
        WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ), members AS (
        SELECT * FROM walks
        UNION ALL SELECT conv_id, 0, 'root', 0, conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM convs
    ), steps AS (
        SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM members
    ), nodes AS (
        SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
        FROM steps GROUP BY node, depth
    ), families AS (
        SELECT n.*, p.conv_id AS parent_conv_id, coalesce(c.n_children, 0) AS n_children
        FROM nodes n LEFT JOIN nodes p ON p.node = n.parent
            LEFT JOIN (SELECT parent, count(*) AS n_children FROM nodes GROUP BY parent) c ON c.parent = n.node
    ), sums AS (
        SELECT m.node, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved_tokens
        FROM families f JOIN members m ON m.conv_id = f.conv_id AND m.depth <= f.depth GROUP BY m.node
    )
    SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
        n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
    FROM families JOIN sums USING (node)
    """,
)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = written_table(trie.numbered(table(spark, sf_dir, "conversations")), "trie-turns")
    found = trie.nodes(rebuilt(turns), turns.where("pos = 0").select("conv_id"))
    return found.select(
        *("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    )


TERMS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


@register(
    "op13_ranked_search",
    rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS row, doc_id, {TERMS_SQL} AS terms FROM documents
    ), total AS (
        SELECT count(*) FILTER (WHERE len(terms) > 0) AS n, sum(len(terms))::BIGINT AS l FROM docs
    ), found AS (
        SELECT row, doc_id, n_terms, term, count(*) AS tf
        FROM (SELECT row, doc_id, len(terms) AS n_terms, unnest(terms) AS term FROM docs) GROUP BY ALL
    ), weights AS (
        SELECT term, floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
        FROM found, total GROUP BY term
    ), asked AS (
        SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({TERMS_SQL}) AS term FROM benchmark) GROUP BY ALL
    ), scores AS (
        SELECT item_id, doc_id,
            sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n_terms * n) // l))))::BIGINT AS score
        FROM asked JOIN found USING (term) JOIN weights USING (term), total GROUP BY item_id, row, doc_id
    ), ranks AS (
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scores WHERE score > 0
    )
    SELECT * FROM ranks WHERE rank <= 10
    """,
)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
