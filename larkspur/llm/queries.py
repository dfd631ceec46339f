"""One query for each operator of this subpackage, on whole tables with production settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import collocations, hard_negatives, html_extraction, mixing, ngram_join, packing, pii, quality_classifier, quality_rules, suffix_tree, token_rollups, topk, url_reputation
from larkspur.llm.registry import QUERIES, SQL, query
from larkspur.session import table

__all__ = ["QUERIES", "SQL"]


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


@query("op1_suffix_tree_scores")
def op1_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a suffix tree learnt from the rows that are not held out."""
    return suffix_tree.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the labels of the rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels.where(fold("doc_id", 3) != 1))
    scored = quality_classifier.quality_scores(docs, model)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def tokenizer_path() -> str:
    """The public byte-level vocabulary, on each machine where the package of vocabularies lies."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def joined_spans(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in pii.KINDS])
    one = F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["begin"], s["end"]))
    return F.array_join(one, ",")


@query("op3_pii_deobfuscation")
def op3_pii_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of what is in plain sight, and all spans."""
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    base, added = F.col("found.base"), F.col("found.added")
    key = lambda s: F.struct(s["begin"].alias("begin"), s["kind"].alias("kind"), s["end"].alias("end"))
    # a one-argument function for each kind: a second argument would get the place in the array
    of_kind = lambda k: lambda s: s["kind"] == k
    counts = [F.size(F.filter(base, of_kind(k))).cast("bigint").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(joined_spans(F.array_sort(F.transform(base, key))).cast("binary"), 256).alias("base_sha256"),
        joined_spans(pii.all_spans(F.col("found"))).alias("spans"), F.size(added).cast("bigint").alias("n_added"),
    )


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2,048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), keep_ids=False)


@query("op5_source_mixing")
def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability of every document after raking to flatter shares, and whether it is sampled."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), mix_dimensions(), MIX_EXPONENTS)
    return mixed.select("row.doc_id", "source", "lang", "topic", "tokens", "probability", "kept")


def mix_dimensions() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic_of(F.col("text"))}


#: Targets: sources, languages and topics nearer to equal shares than they are.
MIX_EXPONENTS = {"source": 0.8, "lang": 0.9, "topic": 0.9}


OP6_SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and list_count(embedding) = len(embedding)
    and list_count(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from whole q join whole c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 50 = 0),
ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
  from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""


@query("op6_dual_tree_top_k", OP6_SQL)
def op6_dual_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors for every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


LONE_BAR = r"(?<![^\x20\x09-\x0D])\|(?![^\x20\x09-\x0D])"
WORD_OR_SIGN = r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"

OP7_SQL = r"""
with counted as (
  select source, lang, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
         len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]')) as signs
  from documents),
kept as (
  select source, lang, len(words) as n, len(list_filter(words, lambda w: w = '|')) as bars, signs from counted where len(words) >= 5)
select source, lang, 'words-1' as version, count(*) as documents, cast(sum(n - bars) as bigint) as tokens from kept group by source, lang
union all
select source, lang, 'signs-1', count(*), cast(sum(signs) as bigint) from kept group by source, lang
"""


@query("op7_token_rollups", OP7_SQL)
def op7_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after a load, a batch of deletes, revisions and a second tokenizer, and both batches sent again.

    The second batch takes out documents of fewer than five words, counts the others anew without lone bars, and
    counts their words and signs under another version.
    """
    text = F.coalesce("text", F.lit(""))
    words, bars = mixing.count_words(text), F.regexp_count(text, F.lit(LONE_BAR))
    docs = table(spark, sf_dir, "documents").select("source", "lang", "text")
    small, large = docs.where(words < 5), docs.where(words >= 5)
    first = token_rollups.inserted(docs, "words-1", words)
    second = (
        token_rollups.deleted(small, "words-1", words)
        .unionByName(token_rollups.revised(large.where(F.contains(text, F.lit("|"))), "words-1", words, words - bars))
        .unionByName(token_rollups.inserted(large, "signs-1", F.regexp_count(text, F.lit(WORD_OR_SIGN))))
    )
    store = token_rollups.create_store(spark)
    for batch, changes in (("load", first), ("revise", second), ("load", first), ("revise", second)):
        token_rollups.commit(spark, store, batch, changes)
    return token_rollups.totals(spark, store)


URL_RULES = [
    url_reputation.Rule("allow", "com"),
    url_reputation.Rule("block", "example.com", "/en/"),
    url_reputation.Rule("allow", "www.example.com", "/en/"),
    url_reputation.Rule("block", "net", "/es/"),
    url_reputation.Rule("block", "net", "/fr/"),
]

_PRIOR_SQL = """
  {level}_k as (
    select coalesce(1 / greatest(least(extra / nullif(scale, 0), 1 / 2.0), 1 / 21.0) - 1, 20.0) as k
    from (select sum(n * (good / n - prior) * (good / n - prior) - prior * (1 - prior)) as extra,
                 sum((n - 1) * prior * (1 - prior)) as scale
          from {level}_n where n > 0)),
"""

OP8_SQL = """
with parts as (
  select page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
  named as (
    select host, regexp_replace(host, '^.*@|[.]?:[0-9]*$|[.]$', '', 'g') as name from (select distinct host from parts)),
  domains as (
    select host, case
      when regexp_matches(name, '^[0-9.]+$') then name
      when regexp_matches(name, '[^.]+[.](ac|co|com|edu|gov|net|org)[.][a-z]{2}$')
        then regexp_extract(name, '([^.]+[.](?:ac|co|com|edu|gov|net|org)[.][a-z]{2})$', 1)
      else regexp_extract(name, '([^.]*[.])?[^.]*$') end as domain
    from named),
  hosts as (
    select host, domain, case
      when regexp_matches(domain, '^[0-9.]+$') or not regexp_matches(domain, '^[^.]+[.].') then domain
      else regexp_extract(domain, '^[^.]+[.](.+)$', 1) end as suffix
    from domains),
  counted as (
    select h.host, h.domain, h.suffix, cast(count(l.quality) as double) as n,
           cast(count(case when l.quality > 0 then 1 end) as double) as good
    from hosts h join parts p on p.host = h.host
    left join labels l on l.doc_id = p.page_id
    group by all),
  overall as (select (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) as prior from counted),
  suffix_n as (
    select suffix, sum(n) as n, sum(good) as good, any_value(prior) as prior from counted cross join overall group by suffix),
""" + _PRIOR_SQL.format(level="suffix") + """
  domain_n as (
    select d.suffix, d.domain, d.n, d.good, (s.good - d.good + k * s.prior) / (s.n - d.n + k) as prior
    from (select suffix, domain, sum(n) as n, sum(good) as good from counted group by all) d
    join suffix_n s on s.suffix = d.suffix cross join suffix_k),
""" + _PRIOR_SQL.format(level="domain") + """
  host_n as (
    select h.host, h.n, h.good, (d.good - h.good + k * d.prior) / (d.n - h.n + k) as prior
    from counted h join domain_n d on d.domain = h.domain cross join domain_k),
""" + _PRIOR_SQL.format(level="host") + """
  posterior as (select host, n, k, (good + k * prior) / (n + k) as mean from host_n cross join host_k),
  judged as (
    select host, case when mean + 1.645 * sqrt(mean * (1 - mean) / (n + k + 1)) < (select prior from overall) then 'block' else 'allow' end as verdict
    from posterior),
  rules(rule, host, path, verdict) as (values
    ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
    ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
  hits as (
    select host, path, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
    from (select u.host, u.path, r.rule, r.verdict from (select distinct host, path from parts) u, rules r
          where (u.host = r.host or ends_with(u.host, '.' || r.host)) and starts_with(u.path, r.path))
    group by all)
select p.page_id, p.host, p.path, h.rule, coalesce(h.verdict, j.verdict) as verdict
from parts p join judged j on j.host = p.host left join hits h on h.host = p.host and h.path = p.path
"""


@query("op8_url_reputation", OP8_SQL)
def op8_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict for every page's url; outcomes are the quality labels with the page's id."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    judged = url_reputation.judge_urls(pages, labels, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op9_ngram_jaccard_join")
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and component of every document under links of 3-word n-grams with a similarity of 0.9 or more."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), ngram_join.Threshold(3, 90))


@query("op10_compression_bands")
def op10_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, line and compression measures of every document, and whether it is kept."""
    found = quality_rules.compression_bands(table(spark, sf_dir, "documents"))
    m = F.col("measures")
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    return found.select(
        "doc_id", *[m[x].alias(x) for x in base],
        failed.alias("base_failed"), (~failed & F.col("in_bands")).alias("kept"),
        *[m[x].alias(x) for x in ("n_bytes", "ratio", "n_chunks", "low_chunks", "high_chunks")],
    )


OP11_SQL = """
with whole as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where label is not null and embedding is not null and list_count(embedding) = len(embedding)
    and list_count(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
scored as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
         cast(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from whole a join whole c on a.vec_id <> c.vec_id and len(a.v) = len(c.v)
  where a.vec_id % 100 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score
  from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id,
       cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as integer) as rank,
       s.vec_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id
where not s.same and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) <= 10
"""


@query("op11_hard_negatives", OP11_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every hundredth vector its five best of the label, and for each ten of other labels that score nearly as high."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


OP12_SQL = r"""
with article as (
  select page_id, url,
         string_split_regex(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '<br>', ' ', 'g'), '</?(p|h1)>') as parts
  from pages),
bare as (select page_id, url, list_transform(parts, lambda x: regexp_replace(x, '<[^>]*>', '', 'g')) as parts from article),
decoded as (
  select page_id, url, list_transform(parts, lambda x:
    trim(regexp_replace(regexp_replace(regexp_replace(x, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) as parts
  from bare)
select page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) as text,
       cast(length(array_to_string(list_filter(parts, lambda x: x <> ''), chr(10))) as bigint) as n_chars
from decoded
"""


@query("op12_html_extraction", OP12_SQL)
def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by the path that the pages of its host agree on.

    The SQL reads the article element of the given pages, whose references are those of ``&`` and ``"``.
    """
    return html_extraction.extract(table(spark, sf_dir, "pages"))


@query("op13_phrase_collocations")
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of two to four words of every language."""
    return collocations.top_phrases(table(spark, sf_dir, "documents"), 2000)
