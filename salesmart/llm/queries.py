"""One query per operator, over its whole table, with the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import (
    bpe_ranks,
    lang_subword,
    line_templates,
    poisson_mix,
    secret_cnn,
    setm_phrases,
    simhash,
    topk_saat,
    toxic_crf,
    url_digest,
    weak_rules,
    whitening,
    wu_manber,
)
from salesmart.llm.common import crc_mod, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# The rules of op8: action, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_topk_saat(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk_saat.top_k(vectors.where("vec_id % 100 = 0"), vectors, k=10)


def op2_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"]
    return weak_rules.judged(docs).select(*columns)


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.deduplicated(docs)


def op4_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxic_model(spark, docs, sf_dir)
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    return toxic_crf.tagged(docs.withColumn("held_out", held_out), model, without=["text"])


def toxic_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxic_crf.Model | None:
    """A tagger learned from the labels outside the held-out third."""
    return toxic_crf.fit(docs, table(spark, sf_dir, "labels").where(crc_mod("doc_id", 3) != 1))


def op5_secret_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_cnn.scanned(docs, secret_cnn.fit(docs), without=["text"])


def op6_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix.mixed(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_url_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_digest.judged(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, without=["url"])


def op9_lang_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = lang_subword.fit(docs.where(crc_mod("doc_id", 4) != 2))
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    return lang_subword.identified(docs.drop("lang").withColumn("held_out", held_out), model, without=["text"])


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_ranks.encode_documents(docs, tokenizer_path(), without=["text"])


def op11_setm_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setm_phrases.phrases(table(spark, sf_dir, "documents").select("lang", "text"))


def op12_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = wu_manber.decontaminated(docs, table(spark, sf_dir, "benchmark"), without=["text"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_topk_saat": op1_topk_saat,
    "op2_weak_rules": op2_weak_rules,
    "op3_line_templates": op3_line_templates,
    "op4_toxic_crf": op4_toxic_crf,
    "op5_secret_cnn": op5_secret_cnn,
    "op6_poisson_mix": op6_poisson_mix,
    "op7_simhash": op7_simhash,
    "op8_url_digest": op8_url_digest,
    "op9_lang_subword": op9_lang_subword,
    "op10_bpe": op10_bpe,
    "op11_setm_phrases": op11_setm_phrases,
    "op12_wu_manber": op12_wu_manber,
    "op13_whitening": op13_whitening,
}

_HOST = "translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's')"
_RULE_CASES = " ".join(
    f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}') then '{host}{path}'"
    for _, host, path in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
)
_BLOCKED = ", ".join(f"'{host}{path}'" for action, host, path in URL_RULES if action == "block")

_SPACE = r"[\x20\x09-\x0D]+"
_FIELD = r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*"
# Parts of a long line's other words: four slices of the words after the first three.
_PARTS = [f"array_to_string(w[4 + (n - 3) * {i} // 4 : 3 + (n - 3) * {i + 1} // 4], ' ')" for i in range(4)]
_OPENED = ", ".join(
    "concat_ws(chr(10), '', n, array_to_string(w[1:3], ' '), {}, {})".format(i, ", ".join(p for j, p in enumerate(_PARTS) if j != i))
    for i in range(4)
)
_LINES = f"""
    lines as (
        select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos
        from documents where text is not null),
    parsed as (
        select doc_id, pos, line, w, len(w) as n from (
            select *, list_filter(regexp_split_to_array(regexp_replace(line, '{_FIELD}', '<*>', 'g'), '{_SPACE}'), lambda x: x != '') as w
            from lines)),
    nodes as (
        select doc_id, pos, line, t, starts_with(t, chr(10)) as open, need from (
            select doc_id, pos, array_to_string(w, ' ') as line,
                unnest(case when n >= 20 then [{_OPENED}, array_to_string(w, ' ')] when n >= 2 then [array_to_string(w, ' ')] else [] end) as t,
                case when n >= 5 then 2 else 50 end as need
            from parsed where doc_id is not null)),
    known as (
        select t, min(doc_id) as first from nodes
        group by t having count(distinct doc_id) >= max(need) and count(distinct doc_id) > 1),
    met as (select * from nodes join known using (t)),
    unsure as (select distinct doc_id, line from met where open and doc_id != first),
    sure as (select distinct t from met anti join unsure using (doc_id, line) where open and doc_id = first),
    dropped as (
        select distinct doc_id, pos from met where doc_id != first and (not open or t in (select t from sure)))
"""
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# The score of the cut after the first k words, in 128 bits.
_SCORE = "(1000::hugeint * c.a::hugeint * n::hugeint) // (l.a::hugeint * r.a::hugeint)"

ORACLE_SQL: dict[str, str] = {
    "op1_topk_saat": """
        with vectors as (
                select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as q from embeddings
                where vec_id is not null and embedding is not null
                    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
             scored as (
                select a.vec_id as query_id, b.vec_id,
                    list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::bigint as score
                from vectors a join vectors b on a.vec_id % 100 = 0 and a.vec_id != b.vec_id),
             ranked as (
                select *, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank from scored)
        select query_id, rank, vec_id, score from ranked where rank <= 10
    """,
    "op3_line_templates": f"""
        with {_LINES},
             left_over as (
                select doc_id, count(*) as n_lines, count(d.pos) as n_dropped,
                    coalesce(string_agg(line, chr(10) order by pos) filter (where d.pos is null), '') as text
                from parsed left join dropped d using (doc_id, pos) group by doc_id)
        select doc_id, l.text, coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped
        from documents left join left_over l using (doc_id)
    """,
    "op6_poisson_mix": """
        with counts as (select source, count(*) as n from documents group by source),
             rates as (
                select source, 1.0::double * (select sum(n) from counts)::double / (select count(*) from counts)::double / n as rate
                from counts),
             terms as (
                select source, rate, k, exp(-rate) * pow(rate, k) / gamma(k + 1) as term
                from rates, range(0, 170) as r(k)),
             reached as (select source, rate, k, sum(term) over (partition by source order by k) as total from terms),
             levels as (select source, rate, list(total order by k) as totals from reached group by source, rate),
             drawn as (
                select d.*, rate, (('0x' || substr(md5('42:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint + 0.5::double) / 4503599627370496 as u, totals
                from documents d join levels l on d.source is not distinct from l.source),
             counted as (select * exclude (u, totals), len(list_filter(totals, lambda x: x < u))::int as copies from drawn)
        select *, md5('42-order:' || coalesce(doc_id::varchar, 'null') || ':' || copy) as mix_key
        from (select *, unnest(range(0, copies))::int as copy from counted)
    """,
    "op8_url_digest": f"""
        with parts as (select page_id, coalesce({_HOST}, '') as host, coalesce({_PATH}, '') as path from pages),
             ruled as (select *, case {_RULE_CASES} end as rule from parts)
        select *, case when rule in ({_BLOCKED}) then 'block' else 'allow' end as verdict from ruled
    """,
    "op11_setm_phrases": f"""
        with pieces as (
                select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
             cut as (
                select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w != '') as w from pieces),
             totals as (select lang, sum(len(w))::bigint as n from cut group by lang),
             grams as (
                select lang, w[i : i + k - 1] as words, k from (
                    select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from cut, range(1, 6) as lengths(k))),
             f as (select lang, words, k, count(*) as a from grams group by all having count(*) >= 100),
             cuts as (
                select c.lang, c.words, c.a, l.a as l, r.a as r, n, {_SCORE} as score,
                    row_number() over (partition by c.lang, c.words order by {_SCORE}, len(l.words)) as place
                from f c join totals using (lang)
                    join f l on l.lang = c.lang and l.k < c.k and l.words = c.words[1 : l.k]
                    join f r on r.lang = c.lang and r.k = c.k - l.k and r.words = c.words[l.k + 1 : c.k]),
             parts as (
                select lang, words[i : i + k - 1] as words, max(a) as most from (
                    select f.lang, f.words, f.a, k.k, unnest(range(1, f.k - k.k + 2)) as i from f join range(2, 5) as k(k) on k.k < f.k)
                group by all),
             kept as (
                select lang, array_to_string(words, ' ') as phrase, a, l, r, n, score::bigint as score
                from cuts left join parts using (lang, words) where place = 1 and (most is null or 100 * most < 100 * a)),
             ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
        select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
    """,
    "op12_wu_manber": f"""
        with words as (
                select doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x != '') as w
                from documents),
             items as (
                select item_id::varchar as item_id,
                    list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x != '') as w
                from benchmark),
             windows as (
                select distinct item_id, size, array_to_string(w[i : i + size - 1], ' ') as passage from (
                    select item_id, w, least(10, len(w)) as size, unnest(range(1, greatest(len(w) - 8, 2))) as i from items where len(w) > 0)),
             sizes as (select distinct size from windows),
             places as (
                select doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') as passage from (
                    select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from words, sizes)),
             met as (select doc_id, i, size, item_id from places join windows using (size, passage)),
             hits as (select doc_id, count(distinct spot) as n_hit from (select doc_id, unnest(range(i, i + size)) as spot from met) group by doc_id),
             named as (
                select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
                from (select distinct doc_id, item_id from met where item_id is not null) group by doc_id)
        select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
            sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from words left join hits using (doc_id) left join named using (doc_id)
    """,
}
