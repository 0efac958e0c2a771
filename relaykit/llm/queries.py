"""The queries of the training-data operators, over the driver's tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, curve_packing, jaccard_join, lexical_search, multi_index, packing, quality_model, quality_rules, shared, source_mix, spelling_variants, suffix_dedup, url_filter, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CONTROL = "<|im_end|><|im_start|>assistant ok"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted(labels: DataFrame) -> DataFrame:
    """Documents that the quality rules' target is counted from."""
    return labels.where("quality = 1 and toxic = 0").select("doc_id")


def weights(docs: DataFrame | SparkSession) -> DataFrame:
    """Target shares of the mixture: each source of ``docs`` alike, null too (a
    session stands for a table without rows)."""
    if isinstance(docs, SparkSession):
        docs = docs.createDataFrame([], "source string")
    return docs.select("source").distinct().withColumn("weight", F.lit(1.0))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = jaccard_join.jaccard_components(_read(spark, sf_dir, "documents"), shingle=3, num=90, den=100)
    return got.select("doc_id", "n_shingles", "component_id", "n_links")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return source_mix.mix(docs, weights(docs))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                      F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = warc.mark_revisits(_read(spark, sf_dir, "pages"), least=0)
    got = warc.read_archives(warc.write_archives(marked, warc.archive_folder(spark)))
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string")
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(control)
    return chat_format.summary(chat_format.examples(turns))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "score", "verdict")


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, TOKENIZER, digest=True)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs, trusted(_read(spark, sf_dir, "labels"))).drop("text")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_variants.vocabulary(_read(spark, sf_dir, "documents"), least=7, occurrences=2, noise=31)
    return spelling_variants.variants(shared.stored(words), least=7, times=10)


def op12_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    got = curve_packing.pack_along_curve(docs, TOKENIZER)
    return got.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), k=10)


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_source_mix, op3_suffix_dedup, op4_warc, op5_quality_classifier,
                                   op6_chat_format, op7_url_filter, op8_multi_index, op9_packing, op10_quality_rules,
                                   op11_spelling_variants, op12_curve_packing, op13_lexical_search)}

_ESCAPED = "replace(replace({}, '\\', '\\\\'), '<|', '<\\|')"
_B32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {5 * g + 1}, 5))::bigint >> {s}) & 31)::integer, 1)"
    for g in range(8) for s in (15, 10, 5, 0))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CRC_TABLE = """select list(list_reduce(list_concat([i], range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as crc from range(256) r(i)"""
#: Bytes of a string s without code points over U+07FF.
_BYTES = """flatten(list_transform(string_split(s, ''), lambda x: case when unicode(x) < 128 then [unicode(x)::bigint]
    else [192 | (unicode(x) >> 6), 128 | (unicode(x) & 63)]::bigint[] end))"""
_TERMS = f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

SQL = {
    "op2_source_mix": source_mix.mix_sql(columns="doc_id, text, lang, source, n_chars"),
    "op4_warc": f"""
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
d as (select page_id, octet_length(b) as n, sha1(b) as h from p),
f as (select *, min(page_id) over (partition by h, n) as first from d)
select page_id, n as payload_bytes, {_B32} as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id = first then null else first end as refers_to from f""",
    "op6_chat_format": f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all values (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')),
e as (select *, length('<|im_start|>' || replace({_ESCAPED.format('role')}, chr(10), '\\n') || chr(10) || {_ESCAPED.format('text')} || '<|im_end|>' || chr(10)) as chars,
             row_number() over w as i, count(*) over (partition by conv_id) as n from t window w as (partition by conv_id order by turn, role, text)),
c as (select *, sum(chars) over (partition by conv_id order by i) as so_far from e)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
       sum(so_far) filter (role = 'assistant' or i = n)::bigint as formatted_chars
from c group by conv_id""",
    "op11_spelling_variants": f"""
with recursive t as ({_CRC_TABLE}),
runs as (select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-zÀ-ÿ]{{7,}}')) as run from documents),
counted as (select id || ':' || run as s, run, count(*) as n from runs group by all),
hashed as (select run, n, xor(list_reduce(list_concat([4294967295::bigint], {_BYTES}), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) as h
           from counted, t),
noised as (select case when h % 31 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from hashed),
v as (select word, sum(n)::bigint as n from noised where length(word) >= 7 group by word having sum(n) >= 2),
d as (select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from v)),
longer as (select distinct d.word, d.n, v.word as near, v.n as near_n from d join v on d.rest = v.word),
pairs as (select a.word, b.word as near, b.n as near_n from d a join d b on a.i = b.i and a.rest = b.rest and a.word <> b.word
          union all select word, near, near_n from longer union all select near, word, n from longer),
best as (select word, count(*) as n_near, first(near order by near_n desc, near) as best, max(near_n) as best_n from pairs group by word),
forms as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when best_n >= 10 * v.n then best end as form, case when best_n >= 10 * v.n then best_n end as form_n
          from v left join best using (word)),
walk as (select word, word as root, form as next from forms
         union all select w.word, f.word, f.form from walk w join forms f on w.next = f.word)
select f.word, f.form, w.root, f.n, f.n_near::bigint as n_near, f.form_n from forms f join walk w on f.word = w.word and w.next is null""",
    "op13_lexical_search": f"""
with docs as (select row_number() over () as r, doc_id, {_TERMS} as t from documents),
stats as (select count(*)::bigint as nn, sum(len(t))::bigint as ll from docs where len(t) > 0),
asked as (select item_id, term, count(*)::bigint as q from (select item_id, unnest({_TERMS}) as term from benchmark) group by all),
bags as (select r, term, count(*)::bigint as tf from (select r, unnest(t) as term from docs) where term in (select term from asked) group by all),
weights as (select term, floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)))::bigint as w from bags, stats group by term, nn),
lengths as (select r, doc_id, 100 - 75 + (75 * len(t) * nn) // ll as m from docs, stats),
scores as (select item_id, r, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
           from asked join bags using (term) join weights using (term) join lengths using (r) group by all)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank, doc_id, score
from scores where score > 0 qualify row_number() over (partition by item_id order by score desc, doc_id) <= 10""",
}
