"""The queries over the given tables that apply the operators of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamfold.llm import chat, concatenated, decontamination, fill_in_middle, fuzzy_lines, licenses, main_text, near_duplicates, packing, quality_rules, secrets, tokens, vector_codes, weak_labels
from loamfold.session import stored

RUNNERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        RUNNERS[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op5_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as pieces of at most 2048 tokens, packed best-fit decreasing."""
    pieces = tokens.token_pieces(table(spark, folder, "documents"), byte_vocabulary())
    light = stored(pieces.withColumn("ids_crc32", tokens.digest(F.col("ids"))).drop("ids"), "pieces")
    return packing.pack(light, ["doc_id", "piece", "ids_crc32"])


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op8_superminhash",
    rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (SELECT a, b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM documents JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)""",
)
def superminhash(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their near-duplicate component, links from a similarity of 0.85 on."""
    return near_duplicates.near_duplicates(table(spark, folder, "documents"), percent=85)


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op6_suffix_arrays",
    f"""WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents), b AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
windows AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, least(len(words), 10) AS n, array_to_string(list_slice(words, i, i + 9), ' ') AS win
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
places AS (SELECT doc_id, n, i, array_to_string(list_slice(words, i, i + n - 1), ' ') AS win
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)),
hits AS (SELECT doc_id, n, i, item_id FROM places JOIN windows USING (n, win)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)""",
)
def suffix_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the words and items of the benchmark passages they hold."""
    found = decontamination.benchmark_matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"), 10, ["doc_id"])
    items = F.sort_array(F.array_distinct(F.array_compact(F.col("matches.item_id"))))
    n_hit = decontamination.words_hit(F.col("matches"))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.size("matches") > 0).alias("contaminated"))


@query("op3_ngram_ratio_rules")
def ngram_ratio_rules(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the base rules and the verdict of the n-gram ratio; trusted are those labelled good."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    trusted = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    ratios = quality_rules.bucket_ratios(docs, trusted)
    return quality_rules.rule_columns(docs, ratios).drop("text")


def _with_test_conversation(spark: SparkSession, folder: str) -> DataFrame:
    odd = "</s>[INST] ok [/INST]"
    rows = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    return table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(rows)


_CONTROL_SQL = r"""([<\[])(\\*)(""" + "|".join(sorted({c[1:].replace("|", r"\|").replace("]", r"\]") for c in chat.CONTROLS}, key=len, reverse=True)) + ")"


@query(
    "op10_event_sourced_chat",
    rf"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, length(regexp_replace(text, '{_CONTROL_SQL}', '\1\2\\\3', 'g')) AS body,
    length(replace(replace(regexp_replace(role, '{_CONTROL_SQL}', '\1\2\\\3', 'g'), '%', '%25'), chr(10), '%0A')) AS head FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(head + body + {len(chat.BEGIN) + len(chat.END) + 2}) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id""",
)
def event_sourced_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations folded from their turns as a log, rendered, and digested from the rendered text."""
    rows = _with_test_conversation(spark, folder)
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    log = rows.withColumns({"message": number, "sequence": number, "kind": F.lit("message")})
    shown = chat.render(chat.fold(log))
    read = shown.withColumns({"turns": chat.read_back(F.col("formatted")), "loss": chat.learned_text(F.col("formatted"), F.col("loss_spans"))})
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op7_owned_secrets")
def owned_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their secrets; a document is a repository, its source the owner."""
    found = secrets.secret_spans(table(spark, folder, "documents"))

    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def count(condition):
        return F.size(F.filter("spans", condition)).cast("long")

    def of_kind(kind):
        return lambda s: s["kind"] == kind

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id",
        *[count(of_kind(kind)).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
        count(lambda s: secrets.live(s["owners"], s["repositories"])).alias("n_live"),
        count(lambda s: ~secrets.live(s["owners"], s["repositories"])).alias("n_copied"),
    )


@query("op9_fuzzy_lines")
def fuzzy_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with one occurrence of each group of equal or nearly equal lines."""
    return fuzzy_lines.deduplicated_lines(table(spark, folder, "documents")).select("doc_id", "n_lines", "n_removed", "text")


_TEMPLATE_SQL = ", ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(licenses.TEMPLATES))


@query(
    "op4_license_inheritance",
    rf"""WITH files AS (
  SELECT doc_id, coalesce(text, '') AS text, CASE WHEN doc_id % 512 = 0 THEN source || '/LICENSE'
    WHEN doc_id % 64 = 0 THEN source || '/p' || (doc_id // 512) || '/LICENSE'
    WHEN doc_id % 8 = 0 THEN source || '/p' || (doc_id // 512) || '/q' || (doc_id // 64 % 8) || '/LICENSE'
    ELSE source || '/p' || (doc_id // 512) || '/q' || (doc_id // 64 % 8) || '/f' || doc_id || '.txt' END AS path FROM documents),
templates AS (SELECT * FROM (VALUES {_TEMPLATE_SQL}) t(template, name, text)),
template_tf AS (SELECT template, name, term, count(*) AS tf FROM
  (SELECT template, name, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS term FROM templates) WHERE term <> '' GROUP BY ALL),
n AS (SELECT count(*) AS n FROM files),
df AS (SELECT term, count(DISTINCT doc_id) AS df FROM
  (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS term FROM files) WHERE term IN (SELECT term FROM template_tf) GROUP BY term),
vocabulary AS (SELECT DISTINCT term, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 AS idf FROM template_tf LEFT JOIN df USING (term), n),
along AS (SELECT template, name, term, tf * idf * idf / sqrt(sum(tf * tf * idf * idf) OVER (PARTITION BY template)) AS along FROM template_tf JOIN vocabulary USING (term)),
segments AS (SELECT doc_id, generate_subscripts(s, 1) AS place, unnest(s) AS segment FROM
  (SELECT doc_id, string_split(text, chr(10)) || CASE WHEN path LIKE '%/LICENSE' THEN [text] ELSE [] END AS s FROM files)),
tf AS (SELECT doc_id, place, term, count(*) AS tf FROM
  (SELECT doc_id, place, unnest(regexp_split_to_array(lower(segment), '[^a-z0-9]+')) AS term FROM segments) WHERE term <> '' GROUP BY ALL),
norms AS (SELECT doc_id, place, sqrt(sum(tf * tf * pow(coalesce(idf, ln(n + 1) + 1), 2))) AS norm FROM tf LEFT JOIN vocabulary USING (term), n GROUP BY ALL),
scores AS (SELECT doc_id, place, template, name, round(sum(tf * along) / any_value(norm), 6) AS score FROM tf JOIN along USING (term) JOIN norms USING (doc_id, place) GROUP BY ALL),
own AS (SELECT doc_id, name AS own_license, score FROM scores WHERE score >= {licenses.LEAST} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, name) = 1),
placed AS (SELECT doc_id, path, regexp_replace(path, '/[^/]*$', '') AS folder, own_license, score FROM files LEFT JOIN own USING (doc_id)),
licensed AS (SELECT folder, own_license AS given FROM placed WHERE path LIKE '%/LICENSE' AND own_license IS NOT NULL QUALIFY row_number() OVER (PARTITION BY folder ORDER BY score DESC, own_license) = 1),
above AS (SELECT DISTINCT p.folder, l.folder AS giver, given FROM (SELECT DISTINCT folder FROM placed) p JOIN licensed l ON p.folder = l.folder OR starts_with(p.folder, l.folder || '/')),
nearest AS (SELECT * FROM above QUALIFY row_number() OVER (PARTITION BY folder ORDER BY length(giver) DESC) = 1)
SELECT doc_id, path, own_license, score, coalesce(own_license, given) AS license, CASE WHEN own_license IS NULL THEN giver END AS inherited_from
FROM placed LEFT JOIN nearest USING (folder)""",
)
def license_inheritance(spark: SparkSession, folder: str) -> DataFrame:
    """The licences of all documents as files of a tree: every 8th is the licence file of a folder, of two levels more every 64th and 512th."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    upper = F.concat(F.col("source"), F.lit("/p"), F.floor(F.col("doc_id") / 512))
    lower = F.concat(upper, F.lit("/q"), F.floor(F.col("doc_id") / 64) % 8)
    path = F.when(F.col("doc_id") % 512 == 0, F.concat(F.col("source"), F.lit("/LICENSE")))
    path = path.when(F.col("doc_id") % 64 == 0, F.concat(upper, F.lit("/LICENSE"))).when(F.col("doc_id") % 8 == 0, F.concat(lower, F.lit("/LICENSE")))
    path = path.otherwise(F.concat(lower, F.lit("/f"), F.col("doc_id"), F.lit(".txt")))
    return licenses.file_licenses(docs.withColumn("path", path), keep=("doc_id", "path"))


@query("op2_weak_label_classifier")
def weak_label_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their vote pattern, weak label, score and verdict."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    columns = ["doc_id", "n_words", "pattern", "posterior", "score", "kept"]
    return weak_labels.scored(docs, weak_labels.fit(docs)).select(columns)


@query("op1_minimum_cut_text")
def minimum_cut_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of all pages."""
    return main_text.extracted(table(spark, folder, "pages"))


@query(
    "op11_learned_rank_cuts",
    r"""WITH lines AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units, sha256('7:' || doc_id) AS h FROM documents),
drawn AS (SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM lines),
cuts AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR text LIKE '%<P>%' OR text LIKE '%<S>%' OR text LIKE '%<M>%' OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM parts""",
)
def learned_rank_cuts(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as fill-in-middle examples cut at lines, and as rebuilt from them."""
    made = fill_in_middle.fill_in_middle(table(spark, folder, "documents"), keep=["doc_id"])
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


@query("op12_concatenate_and_cut")
def concatenate_and_cut(spark: SparkSession, folder: str) -> DataFrame:
    """All documents end to end as one stream of tokens, cut into sequences of 1024."""
    pieces = concatenated.concatenated(table(spark, folder, "documents"), byte_vocabulary())
    return pieces.withColumn("ids_crc32", tokens.digest(F.col("ids"))).drop("ids")


_ROUNDS = 6
_NEAREST = "SELECT vec_id, label, part, p, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (SELECT v.*, entry, list_sum(list_transform(range(1, len(p) + 1), lambda i: (p[i] - c[i]) * (p[i] - c[i]))) AS d FROM parts v JOIN b{0} USING (part)) GROUP BY ALL"
_AVERAGED = """sums{0} AS (SELECT part, entry, i, sum(x) AS total, count(*) AS n FROM (SELECT part, entry, unnest(p) AS x, unnest(range(1, len(p) + 1)) AS i FROM a{0}) GROUP BY ALL),
means{0} AS (SELECT part, entry, list(CAST((total - ((total % n) + n) % n) / n AS BIGINT) ORDER BY i) AS c FROM sums{0} GROUP BY ALL),
b{1} AS MATERIALIZED (SELECT part, entry, coalesce(m.c, b.c) AS c FROM b{0} b LEFT JOIN means{0} m USING (part, entry))"""
_ROUND_SQL = ",\n".join(f"a{i} AS MATERIALIZED ({_NEAREST.format(i)}),\n{_AVERAGED.format(i, i + 1)}" for i in range(_ROUNDS))


@query(
    "op13_equal_average_search",
    f"""WITH whole AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, label, k AS part, v[k * (len(v) // 8) + 1 : (k + 1) * (len(v) // 8)] AS p FROM whole, (SELECT unnest(range(8)) AS k)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM whole ORDER BY vec_id LIMIT 16),
b0 AS MATERIALIZED (SELECT part, entry, p AS c FROM parts JOIN first USING (vec_id)),
{_ROUND_SQL},
final AS MATERIALIZED ({_NEAREST.format(_ROUNDS)}),
codes AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM final GROUP BY ALL),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{_ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM codes, books""",
)
def equal_average_search(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings as codes of eight bytes, with their errors, by vector and by label."""
    rows, books = vector_codes.compressed(table(spark, folder, "embeddings").select("vec_id", "label", "embedding"), rounds=_ROUNDS)
    codes = stored(rows, "vector-codes")
    by_label = stored(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "_label")
    joined = codes.join(by_label, F.col("label").eqNullSafe(F.col("_label")), "left")
    return joined.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
