"""Caption search, filters and projections over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions.patterns import keyword, whole_word
from sievework.operators import search as S
from sievework.plans.registry import load, query

SPEC = S.DatasetSpec(
    name="documents",
    files="documents.parquet",
    text_columns=("text",),
    thresholds={"min_chars": ("n_chars", ">="), "max_chars": ("n_chars", "<=")},
    ranges={"chars": "n_chars"},
    extras={"doc_id": "doc_id", "lang": "lang", "width": "n_chars"},
    order=("doc_id",),
)
SQL_SPACE = r"trim(regexp_replace(text, '[\t\n\f\r ]*[\r\n]+[\t\n\f\r ]*', ' ', 'g'))"


@query("s01_parquet_scan", "select doc_id, lang, source, n_chars from documents")
def s01(spark, sf):
    return spark.read.parquet(SPEC.path(sf)).select("doc_id", "lang", "source", "n_chars")


@query(
    "f01_caption_search",
    rf"""select doc_id, lang, n_chars as width, {SQL_SPACE} as text from documents
    where n_chars >= 200 and (contains(lower(text), 'the') or contains(lower(text), ' les ')) and contains(lower(text), 'on')
      and not coalesce(regexp_matches(text, '(?i)\b(?:idiot|eaux)\b'), false)
    order by doc_id nulls last limit 400 offset 5""",
)
def f01(spark, sf):
    options = {"search": "the|+les+ on", "exclude": "idiot eaux", "min_chars": 200, "limit": 400, "start": 5}
    return S.run_search(spark.read.parquet(SPEC.path(sf)), SPEC, options)


@query("f02_whole_word_exclusion", r"select doc_id, n_chars from documents where not coalesce(regexp_matches(text, '(?i)\b(?:of|der|las)\b'), false)")
def f02(spark, sf):
    return load(spark, sf, "documents").where(S.exclude_words(F.col("text"), "of|der las")).select("doc_id", "n_chars")


@query("f03_numeric_threshold", "select d.doc_id, l.quality, l.toxic from documents d left join labels l on d.doc_id = l.doc_id where l.quality >= 1 and d.n_chars <= 3000")
def f03(spark, sf):
    d, l = load(spark, sf, "documents"), load(spark, sf, "labels")
    return d.join(l, "doc_id", "left").where((F.col("quality") >= 1) & (F.col("n_chars") <= 3000)).select("doc_id", "quality", "toxic")


@query("f04_integer_range", "select p_partkey, p_size from part where p_size between 10 and 20 union all select p_partkey, p_size from part where p_size = 7")
def f04(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", "p_size")
    return p.where(S.in_range(F.col("p_size"), "10-20")).unionByName(p.where(S.in_range(F.col("p_size"), "7")))


@query("f05_unset_options", "select doc_id, lang, n_chars as width, text from documents")
def f05(spark, sf):
    return S.run_search(spark.read.parquet(SPEC.path(sf)), SPEC, {"search": "*", "exclude": " ", "min_chars": None, "newlines": "keep"})


@query("f06_projection_renamed", "select text as caption, doc_id as key, source as origin, n_chars as width from documents")
def f06(spark, sf):
    return load(spark, sf, "documents").select(F.col("text").alias("caption"), F.col("doc_id").alias("key"), F.col("source").alias("origin"), F.col("n_chars").alias("width"))


@query("f07_count_only", "select count(*) as n_rows from documents where n_chars >= 500 and contains(lower(text), 'tion')")
def f07(spark, sf):
    return load(spark, sf, "documents").where(S.predicate(SPEC, {"min_chars": 500, "search": "TION"})).agg(F.count("*").alias("n_rows"))


@query(
    "f08_boolean_keywords",
    r"select doc_id from documents where (regexp_matches(text, '(?i)\bthe\b') and regexp_matches(text, '(?i)\bwith\b')) or regexp_matches(text, '(?i)\bder\b')",
)
def f08(spark, sf):
    groups = S.parse_boolean("the AND with der".split())
    return load(spark, sf, "documents").where(S.match_boolean(F.col("text"), groups, whole_word)).select("doc_id")


@query(
    "f09_keyword_phrase",
    r"""select doc_id, regexp_matches(text, '(?i)(?:^|[^0-9A-Za-z_\pL])of[\s\x0b]+the(?:$|[^0-9A-Za-z_\pL])') as phrase,
    regexp_matches(text, '(?i)of[\s\x0b]+the') as partial from documents""",
)
def f09(spark, sf):
    d = load(spark, sf, "documents")
    return d.select("doc_id", F.rlike("text", F.lit(keyword("of the"))).alias("phrase"), F.rlike("text", F.lit(keyword("of the", partial=True))).alias("partial"))


@query("f10_keyword_hyphens", r"select c_custkey from customer where regexp_matches(c_name, 'Customer[\s-]*#0') or regexp_matches(c_mktsegment, '(?i)house[\s-]*hold')")
def f10(spark, sf):
    c = load(spark, sf, "customer")
    hit = F.rlike("c_name", F.lit(r"Customer[\s-]*#0")) | F.rlike("c_mktsegment", F.lit(r"(?i)house[\s-]*hold"))
    return c.where(hit).select("c_custkey")


@query(
    "f11_keyword_frequencies",
    r"""select 'the' as term, count(*) filter (where regexp_matches(text, '(?i)\bthe\b'))::bigint as n_rows from documents union all
    select 'les', count(*) filter (where regexp_matches(text, '(?i)\bles\b'))::bigint from documents union all
    select 'und', count(*) filter (where regexp_matches(text, '(?i)\bund\b'))::bigint from documents""",
)
def f11(spark, sf):
    return S.term_frequencies(load(spark, sf, "documents"), "text", ["the", "les", "und"], whole_word)


@query("f12_size_gates", "select p_partkey from part where not (p_size < 5) and p_size * p_retailprice >= 100.0 * 100.0 and greatest(p_size, 9) / least(p_size, 9) <= 21.0 / 9.0")
def f12(spark, sf):
    size = F.col("p_size")
    ok = ~(size < 5) & (size * F.col("p_retailprice") >= 100.0 * 100.0) & (F.greatest(size, F.lit(9)) / F.least(size, F.lit(9)) <= 21.0 / 9.0)
    return load(spark, sf, "part").where(ok).select("p_partkey")


@query("f13_oversized_rows", "select l_orderkey, l_linenumber from lineitem where l_quantity * l_extendedprice > 2000000 and l_returnflag in ('A', 'R') order by l_orderkey, l_linenumber")
def f13(spark, sf):
    big = (F.col("l_quantity") * F.col("l_extendedprice") > 2_000_000) & F.col("l_returnflag").isin("A", "R")
    return load(spark, sf, "lineitem").where(big).select("l_orderkey", "l_linenumber").orderBy("l_orderkey", "l_linenumber")


@query("f14_year_overlap", "select o_orderkey from orders where year(o_orderdate) <= 1998 and coalesce(case when o_orderstatus = 'F' then year(o_orderdate) + 2 end, year(o_orderdate)) >= 1996")
def f14(spark, sf):
    first = F.year("o_orderdate")
    last = F.when(F.col("o_orderstatus") == "F", first + 2)
    return load(spark, sf, "orders").where((first <= 1998) & (F.coalesce(last, first) >= 1996)).select("o_orderkey")


@query("f15_decade_membership", "select o_orderkey, (year(o_orderdate) // 10 * 10)::bigint as decade from orders where year(o_orderdate) // 10 * 10 = 1990")
def f15(spark, sf):
    decade = (F.floor(F.year("o_orderdate") / 10) * 10).cast("long")
    return load(spark, sf, "orders").where(decade == 1990).select("o_orderkey", decade.alias("decade"))


@query("f16_region_containment", "select n_nationkey from nation where list_has_any([n_regionkey + 1000, n_nationkey], [1001, 1003, 7])")
def f16(spark, sf):
    chain = F.array(F.col("n_regionkey") + 1000, F.col("n_nationkey"))
    return load(spark, sf, "nation").where(F.arrays_overlap(chain, F.array(F.lit(1001), F.lit(1003), F.lit(7)))).select("n_nationkey")


@query("f17_category_argument", r"select r_regionkey, r_name from region where regexp_replace(lower(r_name), '[_ -]+', ' ', 'g') = 'middle east'")
def f17(spark, sf):
    norm = lambda c: F.regexp_replace(F.lower(c), r"[_ -]+", " ")
    hits = load(spark, sf, "region").where(norm(F.col("r_name")) == norm(F.lit("Middle_East")))
    many = hits.agg(F.when(F.countDistinct("r_regionkey") > 1, F.raise_error(F.lit("ambiguous"))).alias("e"))
    return hits.crossJoin(F.broadcast(many)).where(F.col("e").isNull()).select("r_regionkey", "r_name")


@query(
    "f18_post_filter",
    r"""select event_id from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-21' and user_id in (3, 8, 15, 21, 40)
    and (regexp_matches(event_type, '(?i)^(click|view)') or regexp_matches(props, '"k": [1-4]\d'))""",
)
def f18(spark, sf):
    day = F.to_date("ts")
    text = F.rlike("event_type", F.lit(r"(?i)^(click|view)")) | F.rlike("props", F.lit(r'"k": [1-4]\d'))
    return load(spark, sf, "events").where(day.between("2024-01-05", "2024-01-20") & F.col("user_id").isin(3, 8, 15, 21, 40) & text).select("event_id")


@query("f19_album_filter", r"select p_partkey, p_name from part where p_partkey in (1, 5, 9) or regexp_matches(p_name || ' ' || p_type, '(?i)ring|econ')")
def f19(spark, sf):
    both = F.concat_ws(" ", "p_name", "p_type")
    return load(spark, sf, "part").where(F.col("p_partkey").isin(1, 5, 9) | F.rlike(both, F.lit("(?i)ring|econ"))).select("p_partkey", "p_name")


@query("f20_prefix_filter", "select page_id, url from pages where starts_with(url, 'http://t')")
def f20(spark, sf):
    return load(spark, sf, "pages").where(F.startswith("url", F.lit("http://t"))).select("page_id", "url")


@query("f21_like_search", "select c_custkey, c_name, c_acctbal from customer where c_name ilike '%#00000001%' or c_mktsegment ilike '%build%' order by c_acctbal desc, c_custkey limit 40")
def f21(spark, sf):
    c = load(spark, sf, "customer")
    return c.where(F.ilike("c_name", F.lit("%#00000001%")) | F.ilike("c_mktsegment", F.lit("%build%"))).select("c_custkey", "c_name", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(40)


@query("f22_pending_work", "select o_orderkey from orders join customer on o_custkey = c_custkey where c_nationkey = 2 and (o_orderstatus = 'P' or (o_orderstatus = 'F' and o_orderkey % 5 < 3))")
def f22(spark, sf):
    o, c = load(spark, sf, "orders"), load(spark, sf, "customer")
    tries = F.col("o_orderkey") % 5
    return o.join(c, o.o_custkey == c.c_custkey).where((F.col("c_nationkey") == 2) & ((F.col("o_orderstatus") == "P") | ((F.col("o_orderstatus") == "F") & (tries < 3)))).select("o_orderkey")


@query(
    "f23_interest_rules",
    """select p_partkey, rule, case rule when 'big' then p_size >= 30 when 'dear' then p_retailprice > 1200 when 'pair' then p_size % 2 = 0 and p_retailprice > 1000
    when 'pass' then true end as passes from part, (values ('big'), ('dear'), ('pair'), ('pass'), ('other')) r(rule)""",
)
def f23(spark, sf):
    rules = spark.createDataFrame([("big",), ("dear",), ("pair",), ("pass",), ("other",)], "rule string")
    r = F.col("rule")
    passes = F.when(r == "big", F.col("p_size") >= 30).when(r == "dear", F.col("p_retailprice") > 1200).when(r == "pair", (F.col("p_size") % 2 == 0) & (F.col("p_retailprice") > 1000)).when(r == "pass", F.lit(True))
    return load(spark, sf, "part").join(F.broadcast(rules)).select("p_partkey", "rule", passes.alias("passes"))


@query("f24_interest_tier", "select d.doc_id, case when l.doc_id is null then 1 when l.quality = 1 then 0 else 2 end as tier from documents d left join labels l on d.doc_id = l.doc_id")
def f24(spark, sf):
    d, l = load(spark, sf, "documents"), load(spark, sf, "labels").withColumn("_there", F.lit(True))
    tier = F.when(F.col("_there").isNull(), 1).when(F.col("quality") == 1, 0).otherwise(2)
    return d.join(l, "doc_id", "left").select("doc_id", tier.alias("tier"))


@query("f25_bands", "select p_partkey, case when p_size < 10 then 10 when p_size < 20 then 20 when p_size < 35 then 35 else 100 end as band from part")
def f25(spark, sf):
    band = F.lit(100)
    for limit in (35, 20, 10):
        band = F.when(F.col("p_size") < limit, limit).otherwise(band)
    return load(spark, sf, "part").select("p_partkey", band.alias("band"))


@query(
    "f26_year_mentions",
    r"""with y as (select page_id, regexp_extract_all(html, '[0-9]+') as n from pages)
    select page_id, list_min(list_transform(list_filter(n, lambda x: regexp_full_match(x, '1[89][0-9][0-9]')), lambda x: x::int)) as first_year from y""",
)
def f26(spark, sf):
    numbers = F.regexp_extract_all("html", F.lit("([0-9]+)"), 1)
    years = F.transform(F.filter(numbers, lambda x: F.rlike(x, F.lit("^1[89][0-9][0-9]$"))), lambda x: x.cast("int"))
    return load(spark, sf, "pages").select("page_id", F.array_min(years).alias("first_year"))


@query(
    "f27_worth_saving",
    """select p_partkey, case when p_size < 5 then 'small' when p_retailprice * 0.9 < 950 then 'no gain' when p_size > 45 then 'too large' else 'save' end as reason from part""",
)
def f27(spark, sf):
    reason = F.when(F.col("p_size") < 5, "small").when(F.col("p_retailprice") * 0.9 < 950, "no gain").when(F.col("p_size") > 45, "too large").otherwise("save")
    return load(spark, sf, "part").select("p_partkey", reason.alias("reason"))


@query(
    "f28_watermark_class",
    """select d.doc_id, case when l.toxic is null then null when greatest(l.toxic * 0.7, (1 - l.quality) * 0.4) >= 0.6 then 'marked'
    when greatest(l.toxic * 0.7, (1 - l.quality) * 0.4) < 0.3 then 'clean' else 'uncertain' end as cls from documents d left join labels l on d.doc_id = l.doc_id""",
)
def f28(spark, sf):
    found = F.array(F.col("toxic") * 0.7, (1 - F.col("quality")) * 0.4)
    ran = F.forall(found, lambda x: x.isNotNull())
    conf = F.array_max(found)
    cls = F.when(~ran, None).when(conf >= 0.6, "marked").when(conf < 0.3, "clean").otherwise("uncertain")
    return load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id", "left").select("doc_id", cls.alias("cls"))


@query("f29_undersized", "select p_partkey from part where least(p_size, p_retailprice / 50) < 15 or greatest(p_size, p_retailprice / 50) < 24")
def f29(spark, sf):
    a, b = F.col("p_size").cast("double"), F.col("p_retailprice") / 50
    return load(spark, sf, "part").where((F.least(a, b) < 15) | (F.greatest(a, b) < 24)).select("p_partkey")


@query("s02_split_selection", "select doc_id, lang from documents where lang in ('de', 'fr')")
def s02(spark, sf):
    return load(spark, sf, "documents").where(F.col("lang").isin("de", "fr")).select("doc_id", "lang")


@query("t01_stable_paging", "select doc_id, lang, n_chars from documents order by lang nulls last, n_chars nulls last, doc_id limit 50 offset 30")
def t01(spark, sf):
    return load(spark, sf, "documents").orderBy(*[F.col(c).asc_nulls_last() for c in ("lang", "n_chars", "doc_id")]).offset(30).limit(50).select("doc_id", "lang", "n_chars")


@query("t03_top_by_popularity", "select c_custkey, c_acctbal from customer order by c_acctbal desc, c_custkey limit 40")
def t03(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(40)


@query("t04_newest_not_undone", "select event_id, event_type, value from events where event_type <> 'error' order by event_id desc limit 1")
def t04(spark, sf):
    e = load(spark, sf, "events").where(F.col("event_type") != "error")
    return e.agg(F.max_by(F.struct("event_id", "event_type", "value"), "event_id").alias("r")).select("r.*")


@query("t05_skip_then_limit", "select o_orderkey from orders order by o_orderkey limit 100 offset 200")
def t05(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey").orderBy("o_orderkey").offset(200).limit(100)


@query("t06_candidates_by_members", "select c_custkey, n from (select c_custkey, count(o_orderkey) as n from customer left join orders on c_custkey = o_custkey group by c_custkey) order by coalesce(n, 0) desc, c_custkey limit 30")
def t06(spark, sf):
    c, o = load(spark, sf, "customer"), load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0).cast("long"))
    return c.join(o, "c_custkey", "left").select("c_custkey", n.alias("n")).orderBy(F.desc("n"), "c_custkey").limit(30)


@query("t08_most_common", "select p_brand, count(*) as n from part group by p_brand order by n desc, p_brand limit 5")
def t08(spark, sf):
    return load(spark, sf, "part").groupBy("p_brand").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_brand").limit(5)


@query("x01_newline_folding", rf"select doc_id, {SQL_SPACE} as space, replace(replace(replace(text, chr(13) || chr(10), '\n'), chr(10), '\n'), chr(13), '\n') as escaped from documents")
def x01(spark, sf):
    t = F.col("text")
    return load(spark, sf, "documents").select("doc_id", S.fold_newlines(t).alias("space"), S.fold_newlines(t, "escape").alias("escaped"))


@query("x02_url_cleanup", r"select page_id, trim(regexp_replace(' ' || url || chr(10), '[\r\n]+', '', 'g')) as url from pages")
def x02(spark, sf):
    return load(spark, sf, "pages").select("page_id", S.clean_url(F.concat(F.lit(" "), "url", F.lit("\n"))).alias("url"))


@query("x03_prefix_removal", r"select doc_id, regexp_replace('This image shows the image displays ' || text, '(?i)^(?:(?:this image shows|the image displays|this is)[\t\n\f\r ]*)+', '') as text from documents")
def x03(spark, sf):
    t = F.concat(F.lit("This image shows the image displays "), "text")
    return load(spark, sf, "documents").select("doc_id", S.drop_prefix(t, ["this image shows", "the image displays", "this is"]).alias("text"))


@query("x04_result_slug", r"select doc_id, left(trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-+', '-', 'g'), '-'), 40) as slug from documents")
def x04(spark, sf):
    s = F.regexp_replace(F.lower("text"), "[^a-z0-9]+", "-")
    return load(spark, sf, "documents").select("doc_id", F.substring(F.btrim(F.regexp_replace(s, "-+", "-"), F.lit("-")), 1, 40).alias("slug"))


@query("u01_union_of_roots", "select doc_id as id, n_chars as size, 'doc' as kind from documents union all select page_id, length(html), 'page' from pages")
def u01(spark, sf):
    d = load(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("n_chars").alias("size"), F.lit("doc").alias("kind"))
    p = load(spark, sf, "pages").select(F.col("page_id").alias("id"), F.char_length("html").cast("long").alias("size"), F.lit("page").alias("kind"))
    return d.unionByName(p)
