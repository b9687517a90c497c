"""The registered queries of the operators and the SQL of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import (
    chat,
    interaction,
    katz,
    licenses,
    mixing,
    neighbours,
    packing,
    pii,
    quality,
    repair,
    sharding,
    simhash,
    toxicity,
)
from freshet.llm.common import in_share, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query; ``oracle`` is DuckDB SQL for its result."""

    def register(run):
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    "op8_quality_rules",
    rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
places AS (SELECT r, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8),
windows AS (SELECT p.r, p.i, array_to_string(d.w[p.i:p.i + 7], ' ') AS s FROM places p JOIN d USING (r)),
twice AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS after
          FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM windows) WHERE n > 1),
rep AS (SELECT r, sum(least(8, coalesce(after - i, 8))) AS n FROM twice GROUP BY r),
ln AS (SELECT r, l FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n FROM ln GROUP BY r),
m AS (SELECT doc_id, text, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             coalesce(dup.n_lines, 0) AS n_lines, len(regexp_extract_all(text, '\p{{L}}')) AS letters,
             len(regexp_extract_all(text, '\p{{Lu}}')) AS capitals
      FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
            OR word_chars > 15 * n_words OR word_chars < 2 * n_words
            OR 2 * capitals > letters OR 2 * letters < word_chars) AS kept
FROM b""",
)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures of every document and whether the cascade keeps it."""
    found = quality.measured(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *quality.MEASURES,
        "base_failed",
        (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"),
    )


@query("op9_simhash")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word fingerprints, linked at four or fewer differing bits."""
    found = simhash.groups(read(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select(
        F.col("id").alias("doc_id"),
        # The digest is read as an unsigned number, its first byte is the lowest.
        F.lower(F.concat(*[F.hex(F.substring("fp", k, 1)) for k in range(8, 0, -1)])).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query("op10_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of personal data in every document."""
    found = pii.find(read(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        F.col("id").alias("doc_id"),
        *[count(kind) for kind in pii.BASE],
        F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


@query(
    "op4_mixing",
    r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, 15))::BIGINT AS place
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS total, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
      FROM d GROUP BY source),
o AS (SELECT *, 3.0::DOUBLE * total / weight AS stop FROM s),
l AS (SELECT *, ((SELECT sum(total) FROM s) - 3 * coalesce(sum(total) OVER (ORDER BY stop, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                / (sum(weight) OVER (ORDER BY stop, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
      FROM o),
t AS (SELECT source, total, least(weight::DOUBLE * (SELECT arg_min(level, stop) FROM l WHERE stop >= level), 3.0::DOUBLE * total) AS target FROM l),
b AS (SELECT *, CASE WHEN total > 0 THEN floor(target / total) ELSE 0 END AS rounds FROM t),
c AS (SELECT d.doc_id, d.size, b.total, b.target, b.rounds, b.target - b.rounds * b.total AS lacks,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place) - sum(d.size) OVER (PARTITION BY d.source, d.place) AS before,
             row_number() OVER (PARTITION BY d.source, d.place) AS nth
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, total AS source_size, target,
       (size * (rounds + CASE WHEN size > 0 AND nth <= ceil((lacks - before) / size - 0.5) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c""",
)
def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    found = mixing.taken(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op5_packing")
def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 2048 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


_FORMS = r"<\\*/?s>|\[\\*/?INST\]"
_PLANTED = "</s>[INST] ok [/INST]"


@query(
    "op1_chat_formatting",
    rf"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, k, CASE WHEN k = 0 THEN 'user' ELSE 'assistant' END, '{_PLANTED}' FROM range(2) r(k)),
f AS (SELECT *, length(role) + length(text) + length('<s>[INST][/INST]</s>')
                + len(regexp_extract_all(role, '{_FORMS}')) + len(regexp_extract_all(text, '{_FORMS}')) AS chars FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id""",
)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one made of control strings, formatted and read back."""
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_PLANTED).alias("text"),
    )
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    told = chat.formatted(turns).select("conv_id", "formatted", "loss", chat.parse(F.col("formatted")).alias("turns"))

    def digest(text):
        return F.sha2(text.cast("binary"), 256)

    def line(turn):
        return F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n"))

    told = told.withColumn("loss", F.array_join(chat.masked(F.col("formatted"), F.col("loss")), ""))
    return told.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        digest(F.array_join(F.transform("turns", line), "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        digest(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op6_sharding")
def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of eight of nearly equal bytes."""
    found = sharding.shard(read(spark, sf_dir, "documents"), shards=8)
    return found.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op7_neighbours")
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    found = neighbours.search(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query("op2_toxicity")
def toxic_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labels outside one share of ids."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    found = toxicity.score(docs, labels, ~in_share(F.col("id"), 4, 2))
    return found.select(
        F.col("id").alias("doc_id"),
        in_share(F.col("id"), 4, 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query("op3_katz")
def text_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log probability of every document, by a model of the documents outside one share of ids."""
    learned = ~in_share(F.col("doc_id"), 7, 2)
    found, unigrams = katz.score(read(spark, sf_dir, "documents"), learned)
    return found.select(
        F.col("id").alias("doc_id"),
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(unigrams.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def damaged(turns: DataFrame) -> DataFrame:
    """The given turns with the faults that a digest of conversation and turn deals out."""
    said = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.pmod(
            F.crc32(
                F.concat_ws(
                    ":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" "))
                ).cast("binary")
            ),
            F.lit(20),
        ).alias("fate"),
    )
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    left = said.where("fate != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time"))
    return left.drop("time")


# One bit of a polynomial division, eight of which make an entry of the table.
_CRC_BIT = "(CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
_CRC_TABLE = "SELECT i, i AS c FROM range(256) r(i)"
for _ in range(8):
    _CRC_TABLE = f"SELECT i, {_CRC_BIT} AS c FROM ({_CRC_TABLE})"


def _plus(way: str, cost: str, edit: str) -> str:
    """SQL: a way (nine digits of cost, then the audit) with one more edit."""
    return f"printf('%09d', CAST(substr({way}, 1, 9) AS BIGINT) + {cost}) || substr({way}, 10) || '{edit}'"


# After a turn, and after the insertions that may follow it, by the grammar's states.
_STAY = "CASE WHEN w.broken THEN 5 ELSE 0 END"


@query(
    "op11_repair",
    rf"""
WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM ({_CRC_TABLE})),
fate AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(
                    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
                    lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fate
         FROM conversations, crc),
left_over AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
                     CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                     unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS again
              FROM fate WHERE fate <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i FROM left_over),
marked AS (SELECT *, substr(role, 1, 1) AS initial,
                  CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
                       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                       WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' END AS fault,
                  substr(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1, 1) || substr(role, 1, 1) AS pair
           FROM placed),
w AS (SELECT conv_id, i, initial, coalesce(fault IN ('blank', 'duplicate'), false) AS forced,
             coalesce(fault = 'truncated', false) AS broken FROM marked),
facts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                 count(*) FILTER (fault = 'truncated') AS truncated,
                 count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
          FROM marked GROUP BY conv_id),
ways AS (
  SELECT conv_id, 0::BIGINT AS i, '000000000' AS s0, NULL::VARCHAR AS s1, '000000005I' AS s2, '000000010II' AS s3 FROM facts
  UNION ALL
  SELECT conv_id, i, d0, d1, least(d2, {_plus('d0', '5', 'I')}, {_plus('d1', '5', 'I')}, {_plus('e3', '5', 'I')}),
         least(e3, {_plus('e2', '5', 'I')})
  FROM (SELECT *, least(d3, {_plus('d2', '5', 'I')}) AS e3,
               least(d2, {_plus('d0', '5', 'I')}, {_plus('d1', '5', 'I')}, {_plus('d3', '5', 'I')}) AS e2
        FROM (SELECT w.conv_id, w.i, {_plus('s0', '2', 'D')} AS d0,
                     least({_plus('s1', '2', 'D')}, CASE WHEN NOT w.forced AND w.initial = 's' THEN {_plus('s0', _STAY, 'K')} END) AS d1,
                     least({_plus('s2', '2', 'D')}, CASE WHEN w.forced THEN NULL WHEN w.initial = 'u' THEN {_plus('least(s0, s1, s3)', _STAY, 'K')}
                           ELSE {_plus('least(s0, s1, s3)', _STAY + ' + 1', 'R')} END) AS d2,
                     least({_plus('s3', '2', 'D')}, CASE WHEN w.forced THEN NULL WHEN w.initial = 'a' THEN {_plus('s2', _STAY, 'K')}
                           ELSE {_plus('s2', _STAY + ' + 1', 'R')} END) AS d3
              FROM ways JOIN w ON w.conv_id IS NOT DISTINCT FROM ways.conv_id AND w.i = ways.i + 1))),
best AS (SELECT f.*, substr(least(s0, s3), 1, 9)::BIGINT AS cost, substr(least(s0, s3), 10) AS audit
         FROM ways JOIN facts f ON f.conv_id IS NOT DISTINCT FROM ways.conv_id AND f.n = ways.i),
edits AS (SELECT conv_id, k, substr(audit, k, 1) AS edit FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM best)),
dealt AS (SELECT *, sum((edit <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY k) AS i,
                 sum((edit <> 'D')::INT) OVER (PARTITION BY conv_id ORDER BY k DESC) AS from_end FROM edits),
told AS (SELECT e.conv_id, e.k, CASE WHEN edit = 'K' THEN m.role WHEN from_end % 2 = 1 THEN 'assistant' ELSE 'user' END
                || ':' || CASE WHEN edit = 'I' THEN '' ELSE m.text END AS line
         FROM dealt e LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM e.conv_id AND m.i = e.i AND e.edit <> 'I' WHERE edit <> 'D'),
digest AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY k)) AS h FROM told GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN digest d ON d.conv_id IS NOT DISTINCT FROM o.conv_id""",
)
def repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations: what is wrong with each, its cheapest repair and a digest of that."""
    turns = read(spark, sf_dir, "conversations")
    audits, repaired = repair.repair(damaged(turns))
    convs = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    digests = repair.digests(repaired)
    found = convs.join(audits, convs["conv_id"].eqNullSafe(audits["conv_id"]), "left")
    found = found.join(digests, convs["conv_id"].eqNullSafe(digests["conv_id"]), "left")
    none = F.sha2(F.lit("").cast("binary"), 256)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        convs["conv_id"],
        *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", none).alias("repaired_sha256"),
    )


@query("op12_licenses")
def license_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license phrases and labels of every document."""
    found = licenses.scan(read(spark, sf_dir, "documents"))
    base = F.transform("base", lambda b: b["label"])
    every = F.concat(base, F.transform("finds", lambda f: f["label"]))
    starts = F.transform("base", lambda b: b["word"])
    best = F.array_max(F.transform("finds", lambda f: f["priority"]))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"),
        (F.coalesce(best, F.lit(0)) / 100).alias("score"),
    )


_LETTERS = "(VALUES ('A'), ('B'), ('C'), ('D'), ('E'))"


@query(
    "op13_filter_interaction",
    rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
marks AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
          FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, len(w) < 200 AS a,
             100 * len(list_distinct(w)) < 50 * len(w) AS b,
             100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) AS c,
             regexp_matches(text, '[#$%&*|]') AS d,
             coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
      FROM d LEFT JOIN marks USING (doc_id)),
cells AS (SELECT part, good, toxic, a, b, c, d, e, count(*) AS n FROM f GROUP BY ALL),
orders AS (SELECT p.x || q.x || r.x || s.x || t.x AS o
           FROM {_LETTERS} p(x), {_LETTERS} q(x), {_LETTERS} r(x), {_LETTERS} s(x), {_LETTERS} t(x)
           WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
met AS (SELECT *, least(CASE WHEN a THEN instr(o, 'A') ELSE 9 END, CASE WHEN b THEN instr(o, 'B') ELSE 9 END,
                        CASE WHEN c THEN instr(o, 'C') ELSE 9 END, CASE WHEN d THEN instr(o, 'D') ELSE 9 END,
                        CASE WHEN e THEN instr(o, 'E') ELSE 9 END) AS gone,
               a::INT + b::INT + c::INT + d::INT + e::INT AS n_fails
        FROM cells, orders),
told AS (SELECT part, o, s AS step, substr(o, s, 1) AS letter,
                coalesce(sum(n) FILTER (gone > s), 0) AS kept, coalesce(sum(n) FILTER (gone = s), 0) AS removed,
                coalesce(sum(n) FILTER (gone < s AND failing), 0) AS redundant,
                coalesce(sum(n) FILTER (failing AND n_fails = 1), 0) AS unique_fails,
                coalesce(sum(n) FILTER (gone = s AND good), 0) AS good_lost, coalesce(sum(n) FILTER (gone = s AND toxic), 0) AS toxic_lost
         FROM (SELECT *, CASE substr(o, s, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS failing
               FROM met, range(1, 6) r(s)) GROUP BY ALL)
SELECT part, o AS filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM told""",
)
def filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each order of five filters keeps and removes at each step, by language."""
    return interaction.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
