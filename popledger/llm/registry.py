"""The queries opN_<name> over the test tables. Each derives the columns of its contract from its operator's result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from popledger.llm import (
    bpe, clustering, decontaminate, lexical_search, license_scan, ngram_join, quality, substring_dedup, suffix_dedup, tokenfiles, topk_search, toxicity,
    url_rules,
)
from popledger.llm.common import shared_folder, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    """Tokenizer file of the queries; the operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


ORACLES["op1_ngram_jaccard_join"] = r"""
with recursive w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents
), g as materialized (
    select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) < 3 then [array_to_string(words, ' ')]
        else list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i : i + 2], ' ')) end) as gram from w
), n as materialized (select doc_id, count(*) as n from g group by 1
), p as materialized (
    select a.doc_id as a, b.doc_id as b, count(*) as common from g a join g b on a.gram = b.gram and a.doc_id < b.doc_id group by 1, 2
), l as materialized (
    select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * common >= 90 * (x.n + y.n - common)
), e as materialized (select a, b from l union all select b, a from l
), r as (
    select distinct a as doc_id, a as other from e union select r.doc_id, e.b from r join e on e.a = r.other
)
select w.doc_id, coalesce(n.n, 0) as n_shingles, least(w.doc_id, coalesce(c.least, w.doc_id)) as component_id
from w left join n using (doc_id) left join (select doc_id, min(other) as least from r group by 1) c using (doc_id)
"""


@query
def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = topk_search.top_k(vectors, vectors.where("vec_id % 50 = 0"))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


ORACLES["op2_exact_topk"] = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
    where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
    from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)
), r as (
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s
)
select query_id, rank, vec_id, score from r where rank <= 5
"""


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op3_benchmark_decontamination"] = r"""
with d as materialized (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents
), i as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark
), b as materialized (
    select distinct item_id, size, array_to_string(words[pos : pos + size - 1], ' ') as gram
    from (select *, unnest(range(1, len(words) - size + 2)) as pos from (select *, least(len(words), 10) as size from i) where size > 0)
), h as materialized (
    select doc_id, pos, x.size, array_to_string(words[pos : pos + x.size - 1], ' ') as gram
    from (select *, unnest(range(1, len(words) - size + 2)) as pos from d, (select distinct size from b)) x
), f as materialized (select h.doc_id, h.pos, h.size, b.item_id from h join b using (size, gram)
), c as (select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(pos, pos + size)) as word from f) group by 1
), o as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as varchar) as item from f) group by 1
)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (doc_id) left join o using (doc_id)
"""


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", quality.is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op5_substring_dedup"] = r"""
with d as materialized (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), w as materialized (
    select doc_id, pos, array_to_string(words[pos : pos + 34], ' ') as gram from (select *, unnest(range(1, len(words) - 33)) as pos from d)
), f as materialized (select doc_id, pos from w where gram in (select gram from w group by 1 having count(*) > 1)
), p as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as pos from d
), c as materialized (
    select p.doc_id, p.word, p.pos, max(f.pos) over (partition by p.doc_id order by p.pos) as last from p left join f on f.doc_id = p.doc_id and f.pos = p.pos
)
select d.doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(removed, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join (
    select doc_id, count(*) filter (coalesce(pos - last < 35, false)) as removed, string_agg(word, ' ' order by pos) filter (not coalesce(pos - last < 35, false)) as kept from c group by 1
) using (doc_id)
"""


@query
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op8_suffix_array_dedup"] = r"""
with d as materialized (select doc_id, hex(encode(coalesce(text, ''))) as bytes, octet_length(encode(coalesce(text, ''))) as n from documents
), w as materialized (
    select doc_id, pos, md5(substr(bytes, 2 * pos + 1, 100)) as gram from (select *, unnest(range(n - 49)) as pos from d)
), f as materialized (
    select w.doc_id, w.pos from w join (select gram, min(doc_id) as least from w group by 1 having count(distinct doc_id) > 1) using (gram) where least < w.doc_id
), s as (
    select doc_id, pos, pos + 50 as until, lag(pos + 50) over (partition by doc_id order by pos) as before from f
), r as materialized (
    select doc_id, min(pos) as a, max(until) as b from (select *, sum(case when before is null or before < pos then 1 else 0 end) over (partition by doc_id order by pos) as run from s) group by doc_id, run
), k as (
    select doc_id, b as a, lead(a) over (partition by doc_id order by a) as b, 1 as part from r union all select doc_id, 0, min(a), 0 from r group by 1
), t as (
    select d.doc_id, string_agg(substr(bytes, 2 * k.a + 1, 2 * (coalesce(k.b, n) - k.a)), '' order by k.a, k.part) as kept from d join k using (doc_id) group by 1
)
select d.doc_id, cast(n as bigint) as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed, coalesce(spans, 0) as n_spans, sha256(unhex(coalesce(t.kept, bytes))) as kept_sha256
from d left join (select doc_id, sum(b - a) as removed, count(*) as spans from r group by 1) using (doc_id) left join t using (doc_id)
"""


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op7_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    found = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", quality.is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/tokens-{uuid.uuid4().hex[:12]}"
    manifest = stored(tokenfiles.write(table(spark, sf_dir, "documents"), folder, tokenizer_path()), "token-manifest")
    return tokenfiles.read(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_ranked_search"] = r"""
with t as (
    select k, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from (select row_number() over () as k, doc_id, text from documents)
), d as (select k, any_value(doc_id) as doc_id, count(*) as n from t group by k
), a as (select count(*) as docs, cast(sum(n) as bigint) as terms from d
), tf as (select k, term, count(*) as tf from t group by k, term
), w as (select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w from tf, a group by term, docs
), m as (select k, doc_id, 25 + (75 * n * docs) // terms as m from d, a
), i as (
    select j, item_id, term, count(*) as times from (
        select j, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from (select row_number() over () as j, item_id, text from benchmark)
    ) group by j, item_id, term
), s as (
    select j, item_id, k, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
    from i join tf using (term) join w using (term) join m using (k) group by j, item_id, k, doc_id
), r as (
    select item_id, cast(row_number() over (partition by j order by score desc, doc_id) as integer) as rank, doc_id, score from s where score > 0
)
select item_id, rank, doc_id, score from r where rank <= 10
"""

#: Explicit rules of the contract: verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Pages of labelled documents, blocked if the document is toxic or of low quality. A page shows the document whose number
    ends its path."""
    number = F.regexp_extract(url_rules.url_parts(F.col("url"))["path"], r"/([0-9]{1,18})(\.html)?/?$", 1)
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("blocked"))
    return pages.select("url", number.try_cast("bigint").alias("doc_id")).join(marked, "doc_id").select("url", "blocked")


@query
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = url_rules.mine(labelled_urls(pages, table(spark, sf_dir, "labels")))
    return url_rules.judge(pages, rules, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op12_url_filter"] = r"""
with c as (
    select page_id, url, coalesce(case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end, '') as rest from pages
), p as (
    select page_id, url, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
        translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        [regexp_extract(rest, '^([^/?#]*)', 1), regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), regexp_extract(rest, '^[^?#]*\?([^#]*)', 1),
            regexp_extract(rest, '^[^#]*#((?s:.*))', 1)] as texts
    from c
), w as materialized (
    select page_id, url, host, path, list_distinct(flatten(list_transform(texts, lambda x, i: list_transform(list_filter(
        regexp_split_to_array(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
        lambda y: y <> '' and not regexp_full_match(y, '[0-9]+')), lambda y: ['h:', 'p:', 'q:', 'f:'][i] || y)))) as words
    from p
), m as (
    select doc_id, max(toxic = 1 or quality = 0) as blocked from labels where doc_id is not null group by doc_id
), l as materialized (
    select row_number() over () as k, words, blocked
    from w join m on m.doc_id = try_cast(regexp_extract(path, '/([0-9]{1,18})(\.html)?/?$', 1) as bigint) where blocked is not null
), a as (select count(*) as n, count(*) filter (blocked) as bad from l
), o as (select k, unnest(words) as word, blocked from l
), v as (
    select word, row_number() over (order by abs(count(*) filter (blocked) * any_value(n) - count(*) * any_value(bad)) desc, word) as place
    from o, a group by word having count(*) >= ceil(0.005 * any_value(n)) qualify place <= 256
), i as (select k, blocked, list(word order by place)[1:8] as items from o join v using (word) group by k, blocked
), s as (
    select list_sort(list_filter(items, lambda x, j: (bits >> (j - 1)) & 1 = 1)) as rule, blocked
    from (select items, blocked, unnest(range(1, cast(2 ** len(items) as bigint))) as bits from i)
), f as (select rule, cast(count(*) as double) as n, cast(count(*) filter (blocked) as double) as b from s group by rule
), r as (
    select rule from f where b >= (select ceil(0.005 * n) from a)
        and (b / n + 16.0 / n / 2 - 4.0 * sqrt((b / n * (1 - b / n) + 16.0 / n / 4) / n)) / (1 + 16.0 / n) >= 0.5
), e as (
    select *, case
        when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
        when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
        when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
        when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule from w
)
select page_id, host, path, e.rule, case when e.rule in ('example.net/en/', 'org/fr/') then 'allow' when e.rule is not null then 'block'
    when exists (select 1 from r where list_has_all(words, r.rule)) then 'block' else 'allow' end as verdict
from e
"""


@query
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clustering.cluster(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def clustering_sql(k: int, rounds: int) -> str:
    """Rounds of assignment and exact means, written out."""
    steps = [
        """v as materialized (
    select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as e from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
)""",
        """x as materialized (select vec_id, unnest(e) as x, unnest(range(64)) as i from v)""",
        f"""h as (select vec_id, cast(row_number() over (order by sha256('1:' || vec_id)) - 1 as integer) as c from v qualify c < {k})""",
        """c0 as materialized (select h.c, x.i, x.x from h join x using (vec_id))""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""d{r} as materialized (
    select vec_id, c, sum((x.x - c{r}.x) * (x.x - c{r}.x)) as d from x join c{r} using (i) group by vec_id, c
)""")
        steps.append(f"a{r} as materialized (select vec_id, c, d from d{r} qualify row_number() over (partition by vec_id order by d, c) = 1)")
        if r < rounds:
            steps.append(f"""c{r + 1} as materialized (
    select c, i, coalesce(cast(s // n - case when s % n < 0 then 1 else 0 end as bigint), c{r}.x) as x
    from c{r} left join (select c, i, cast(sum(x) as bigint) as s, count(*) as n from a{r} join x using (vec_id) group by c, i) using (c, i)
)""")
    return "with " + ",\n".join(steps) + f"""
select vec_id, a{rounds}.c as cluster, cast(d as bigint) as distance, cast(sum(d) over (partition by a{rounds}.c) as bigint) as cluster_inertia,
    cast(sum(d) over () as bigint) as inertia, z as centroid_sha256
from a{rounds} join (select c, sha256(string_agg(x, ',' order by i)) as z from c{rounds} group by c) as f on f.c = a{rounds}.c
"""


ORACLES["op13_centroid_clustering"] = clustering_sql(16, 3)
