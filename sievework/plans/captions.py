"""Text, date, arithmetic, array and JSON functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import dates as D
from sievework.functions import geometry as G
from sievework.functions import text as X
from sievework.plans.registry import load, query

SQ = r"trim(regexp_replace({}, '[ \t\n\r\f]+', ' ', 'g'))"


def docs(spark, sf):
    return load(spark, sf, "documents")


@query(
    "x05_social_caption",
    r"""with a as (select doc_id, regexp_replace('[club7|Some Group] ' || text || ' #tag @user https://a.b/c .', '\[[^\]|]*\|([^\]]*)\]', '\1', 'g') as t from documents),
    b as (select doc_id, regexp_replace(regexp_replace(t, 'https?://[^ \t\n\r\f]+', '', 'g'), '[#@][0-9A-Za-z_]+', '', 'g') as t from a),
    c as (select doc_id, regexp_replace(trim(regexp_replace(t, '[ \t\n\r\f]+', ' ', 'g')), ' +([,.;:!?])', '\1', 'g') as t from b)
    select doc_id, case when regexp_matches(t, '[0-9A-Za-z_\pL]') then t else '' end as caption from c""",
)
def x05(spark, sf):
    t = F.concat(F.lit("[club7|Some Group] "), "text", F.lit(" #tag @user https://a.b/c ."))
    return docs(spark, sf).select("doc_id", X.clean_social_caption(t).alias("caption"))


@query("x06_import_caption")
def x06(spark, sf):
    t = F.concat("text", F.lit("\r\nsee www.a.b/c and t.me/x #tag @user , end\n---\n mail@host.org"))
    return docs(spark, sf).select("doc_id", X.clean_import_caption(t).alias("caption"))


@query(
    "x07_markup_cleaning",
    r"""with a as (select page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') as t from pages),
    b as (select page_id, replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') as t from a)
    select page_id, trim(regexp_replace(regexp_replace(regexp_replace(t, 'https?://[^ \t\n\r\f]+|www\.[^ \t\n\r\f]+', '', 'g'), '-{4,}|_{4,}|={4,}|\*{4,}|~{4,}|\.{4,}|—{4,}|–{4,}', ' ', 'g'), '[ \t\n\r\f]+', ' ', 'g'), ' ,;') as body from b""",
)
def x07(spark, sf):
    return load(spark, sf, "pages").select("page_id", X.strip_markup(F.col("html")).alias("body"))


@query(
    "x08_drop_segments",
    r"""select doc_id, array_to_string(list_filter(list_transform(string_split(text, '. '), lambda s: trim(s)), lambda s: s <> '' and not regexp_matches(s, 'the|http')), '. ') as kept from documents""",
)
def x08(spark, sf):
    return docs(spark, sf).select("doc_id", X.drop_segments(F.col("text"), r"\. ", "the|http").alias("kept"))


@query("x08_description")
def x08_description(spark, sf):
    t = F.concat(F.lit("Вид на мост. Публикуется с разрешения автора. "), "text", F.lit("<br>See <a href='x'>here</a>.<br />Точка условна. The end ,;"))
    return docs(spark, sf).select("doc_id", X.description(t).alias("kept"))


@query("x09_cap_text", r"select doc_id, case when length(text) > 120 then rtrim(regexp_replace(left(text, 120), ' [^ ]*$', ''), ' ,;:') || '...' else text end as capped from documents")
def x09(spark, sf):
    return docs(spark, sf).select("doc_id", X.cap_text(F.col("text"), 120).alias("capped"))


@query(
    "x10_composed_caption",
    """with p as (select p_partkey, p_name || '.' as a, case when contains(lower(p_name || '.'), lower(p_type)) then null else p_type || '.' end as b, p_brand from part),
    q as (select p_partkey, concat_ws(' ', a, b) as t, p_brand from p) select p_partkey, case when contains(lower(t), lower(p_brand)) then t else t || ' ' || p_brand || '.' end as caption from q""",
)
def x10(spark, sf):
    p = load(spark, sf, "part")
    return p.select("p_partkey", X.compose_caption([F.col("p_name"), F.lit(" "), F.col("p_type"), F.lit(None).cast("string"), F.col("p_brand"), F.col("p_name")]).alias("caption"))


@query("x11_year_span", "select o_orderkey, case when o_orderkey % 3 = 0 then year(o_orderdate)::varchar else year(o_orderdate) || '-' || (year(o_orderdate) + 2) end as span from orders")
def x11(spark, sf):
    y = F.year("o_orderdate")
    return load(spark, sf, "orders").select("o_orderkey", D.year_span(y, F.when(F.col("o_orderkey") % 3 == 0, y).otherwise(y + 2)).alias("span"))


@query("x12_homoglyphs", "select c_custkey, array_to_string(list_transform(string_split('Cтapый ' || c_mktsegment, ' '), lambda w: case when regexp_matches(w, '[Ѐ-ӿ]') then translate(w, 'aceopxyACEHKMOPTXBĸᴏοᴍëΓᴙᴦʜΒΜκΚɜΗΠ', 'асеорхуАСЕНКМОРТХВкоомёГягнВМкКзНП') else w end), ' ') as t from customer")
def x12(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", X.repair_homoglyphs(F.concat(F.lit("Cтapый "), "c_mktsegment")).alias("t"))


@query("x13_footer")
def x13(spark, sf):
    lines = F.split(F.concat_ws("\n", "text", F.lit("Подписывайтесь на наш канал!"), F.lit(""), F.lit("Old Town | photos"), F.lit("https://a.b/c"), F.lit("more here:")), "\n")
    rule = lambda line: X.footer_line(line, "Old Town", F.array(F.lit("more here")))
    return docs(spark, sf).select("doc_id", F.array_join(X.strip_footer(lines, rule), "\n").alias("body"))


@query("x14_sentences")
def x14(spark, sf):
    s = X.sentences(F.col("text"))
    return docs(spark, sf).select("doc_id", F.size(s).alias("n"), F.get(s, 0).alias("first"))


@query("x15_question_trimming")
def x15(spark, sf):
    return docs(spark, sf).select("doc_id", X.trim_questions(F.concat(F.lit("Really? Красиво, правда? "), "text")).alias("t"))


@query("x16_word_budget")
def x16(spark, sf):
    t = X.truncate_words(F.col("text"), 80)
    return docs(spark, sf).select("doc_id", t.alias("t"), X.word_count(t).alias("n_words"))


@query("x17_cut_before_phrase")
def x17(spark, sf):
    return docs(spark, sf).select("doc_id", X.cut_before_sentence(F.concat("text", F.lit(". This has a watermark here. More.")), "watermark").alias("t"))


@query("x18_cut_before_script")
def x18(spark, sf):
    return docs(spark, sf).select("doc_id", X.cut_before_script(F.concat(F.lit("First one. "), "text", F.lit(". Это конец. After."))).alias("t"))


@query(
    "x19_medium",
    r"""with t as (select p_partkey, lower(left(case p_size % 4 when 0 then 'A black and white ' when 1 then 'Color ' when 2 then 'a monochrome ' else 'An old ' end || p_name, 80)) as h from part),
    m as (select p_partkey, regexp_matches(h, '^(?:an? )?(?:black[- ]and[- ]white|monochrome|grayscale|sepia)') as b, regexp_matches(h, '^(?:an? )?(?:full[- ])?colou?r(?:ed|ful)?\b') as c from t)
    select p_partkey, case when b and not c then 'bw' when c and not b then 'color' else 'ambiguous' end as medium from m""",
)
def x19(spark, sf):
    k = F.col("p_size") % 4
    head = F.when(k == 0, "A black and white ").when(k == 1, "Color ").when(k == 2, "a monochrome ").otherwise("An old ")
    return load(spark, sf, "part").select("p_partkey", X.medium(F.concat(head, "p_name")).alias("medium"))


@query("x20_drop_medium", r"select p_partkey, case when regexp_matches(p_name, '^[aeiouAEIOU]') then 'An ' else 'A ' end || p_name as t from part")
def x20(spark, sf):
    return load(spark, sf, "part").select("p_partkey", X.drop_medium(F.concat(F.lit("A monochrome "), "p_name")).alias("t"))


@query(
    "x22_colour_mode",
    r"""select doc_id, case when regexp_matches(text, '(?i)\b(?:black[- ]and[- ]white|monochrome|grayscale)') then 'bw' when regexp_matches(text, '(?i)\b(?:sepia)') then 'sepia' when regexp_matches(text, '(?i)\b(?:film|analog)') then 'film'
    when regexp_matches(text, '(?i)\b(?:painting|drawing)') then 'painting' when regexp_matches(text, '(?i)\b(?:colou?r)') then 'color' else 'unknown' end as mode from documents where lang = 'en'""",
)
def x22(spark, sf):
    return docs(spark, sf).where(F.col("lang") == "en").select("doc_id", X.colour_mode(F.col("text")).alias("mode"))


@query(
    "x23_rule_validator",
    r"""with w as (select doc_id, text, len(regexp_extract_all(text, '[^ \t\n\r\f]+')) as n from documents)
    select doc_id, list_filter([case when n < 50 then 'fewer than 50 words' end, case when n > 400 then 'more than 400 words' end, case when not regexp_matches(trim(text), '[.!?]$') then 'no final stop' end,
    case when contains(text, chr(10)) then 'line break' end, case when contains(lower(text), 'idiot') then 'banned: idiot' end], lambda x: x is not null) as reasons from w""",
)
def x23(spark, sf):
    return docs(spark, sf).select("doc_id", X.failures(F.col("text"), 50, 400, ["idiot"]).alias("reasons"))


CONCEPTS = {"article": r"\b(?:the|le|der)\b", "number": r"[0-9]", "url": r"https?://", "mail": r"@"}
CONCEPT_SQL = "list_filter([" + ", ".join(f"case when regexp_matches({{0}}, '{p}') then '{n}' end" for n, p in CONCEPTS.items()) + "], lambda x: x is not null)"


@query("x24_concepts", f"select doc_id, {CONCEPT_SQL.format('text')} as found from documents where lang <> 'fr'")
def x24(spark, sf):
    from sievework.functions.patterns import BOUNDARY

    table = {n: p.replace(r"\b", BOUNDARY) for n, p in CONCEPTS.items()}
    return docs(spark, sf).where(F.col("lang") != "fr").select("doc_id", X.concepts(F.col("text"), table).alias("found"))


@query(
    "x25_fact_leakage",
    r"""with f as (select distinct doc_id // 10 as batch, doc_id, unnest(regexp_extract_all(text, '[0-9]{3,}')) as fact from documents)
    select a.doc_id as item, b.doc_id as from_item, a.fact from f a join f b on a.batch = b.batch and a.fact = b.fact and a.doc_id <> b.doc_id""",
)
def x25(spark, sf):
    f = docs(spark, sf).select(F.floor(F.col("doc_id") / 10).alias("batch"), "doc_id", F.explode(F.regexp_extract_all("text", F.lit("([0-9]{3,})"), 1)).alias("fact")).distinct()
    o = f.select("batch", "fact", F.col("doc_id").alias("from_item"))
    return f.join(o, ["batch", "fact"]).where("doc_id <> from_item").select(F.col("doc_id").alias("item"), "from_item", "fact")


@query("x26_transliteration")
def x26(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", X.transliterate(F.concat(F.lit("Щука и Ёж — café "), "c_name")).alias("t"))


@query("x21_russian_medium")
def x21(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", X.strip_russian_medium(F.concat("c_name", F.lit("., Цветная фотография дома. На чёрно-белом снимке."))).alias("t"))


@query("x27_budgeted_prefix")
def x27(spark, sf):
    parts = F.array("p_brand", "p_type", F.concat_ws(" ", "p_name", "p_name", "p_name"))
    return load(spark, sf, "part").select("p_partkey", X.budgeted_prefix(30)(parts).alias("prefix"))


@query("x28_folder_safe_name", r"select page_id, left(trim(regexp_replace(regexp_replace(url, '[\\/:*?\x22<>|]', '_', 'g'), '_{2,}', '_', 'g'), ' ._'), 60) as name from pages")
def x28(spark, sf):
    return load(spark, sf, "pages").select("page_id", X.clean_name(F.col("url"), 60).alias("name"))


@query("x29_word_count", r"select doc_id, len(regexp_extract_all(text, '[^ \t\n\r\f]+'))::int as n_words from documents")
def x29(spark, sf):
    return docs(spark, sf).select("doc_id", X.word_count(F.col("text")).alias("n_words"))


@query("x30_first_sentence", r"select doc_id, regexp_extract(text, '^(?s:.*?)[.!?](?:[ \t\n\r\f]|$)|^(?s:.*)$') as t0, rtrim(t0, ' ' || chr(9) || chr(10) || chr(13) || chr(12)) as first from documents")
def x30(spark, sf):
    raw = F.regexp_extract("text", r"^(?s:.*?)[.!?](?:[ \t\n\r\f]|\z)|^(?s:.*)\z", 0)
    return docs(spark, sf).select("doc_id", raw.alias("t0"), F.rtrim(raw, F.lit(" \t\n\r\f")).alias("first"))


@query("x31_ascii_url")
def x31(spark, sf):
    return load(spark, sf, "pages").select("page_id", X.ascii_url(F.concat("url", F.lit("&q=é ü"))).alias("url"))


@query("x32_model_reply", r"select conv_id, turn, trim(regexp_replace(regexp_replace('<think>a' || chr(10) || 'b</think> ' || text || ' <|end|>', '(?s)<think>.*?</think>', '', 'g'), '<\|[^|>]*\|>', '', 'g')) as reply, 'Role: ' || role || ' #' || turn as prompt from conversations")
def x32(spark, sf):
    t = F.concat(F.lit("<think>a\nb</think> "), "text", F.lit(" <|end|>"))
    return load(spark, sf, "conversations").select("conv_id", "turn", X.strip_thinking(t).alias("reply"), X.fill_template("Role: {role} #{turn}", {"role": F.col("role"), "turn": F.col("turn")}).alias("prompt"))


@query("x33_verdict_letter", r"select conv_id, turn, case when upper(regexp_extract(text, '^[^A-Za-z]*([A-Za-z])', 1)) in ('Y', 'N', 'I') then upper(regexp_extract(text, '^[^A-Za-z]*([A-Za-z])', 1)) end as verdict from conversations")
def x33(spark, sf):
    return load(spark, sf, "conversations").select("conv_id", "turn", X.verdict_letter(F.col("text")).alias("verdict"))


@query("x34_encoding_guess", "select doc_id, text from documents")
def x34(spark, sf):
    raw = F.when(F.col("doc_id") % 2 == 0, F.encode("text", "UTF-8")).otherwise(F.encode("text", "UTF-16"))
    return docs(spark, sf).select("doc_id", X.decode_text(raw).alias("text"))


@query("x40_day_bounds", "select distinct strftime(ts, '%Y-%m-%d') as day, epoch(date_trunc('day', ts))::bigint as first, epoch(date_trunc('day', ts))::bigint + 86399 as last from events")
def x40(spark, sf):
    d = load(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day")).distinct()
    first, last = D.day_bounds(F.col("day"))
    return d.select("day", first.alias("first"), last.alias("last"))


@query("x41_unix_to_text", "select event_id, strftime(to_timestamp(1600000000 + event_id * 86399) at time zone 'UTC', '%Y-%m') as month, strftime(to_timestamp(1600000000 + event_id * 86399) at time zone 'UTC', '%Y-%m-%d') as day from events")
def x41(spark, sf):
    s = F.lit(1_600_000_000) + F.col("event_id") * 86_399
    return load(spark, sf, "events").select("event_id", D.month_of(s).alias("month"), D.iso_day(s).alias("day"))


@query(
    "x42_period_start",
    """with d as (select o_orderkey, o_orderdate::date as d from orders), r as (select *, date_trunc('month', d)::date + (least(31, day(last_day(d))) - 1)::int as here,
    date_trunc('month', d - interval 1 month)::date as pm from d) select o_orderkey, case when d >= here then here else pm + (least(31, day(last_day(pm))) - 1)::int end as start from r""",
)
def x42(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", D.period_start(F.to_date("o_orderdate"), 31).alias("start"))


@query("x43_freshness", "select event_id, case when event_id % 11 = 0 then false else date '2024-01-31' - ts::date <= 14 end as fresh from events")
def x43(spark, sf):
    checked = F.when(F.col("event_id") % 11 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return load(spark, sf, "events").select("event_id", D.is_fresh(checked, F.lit("2024-01-31").cast("date"), 14).alias("fresh"))


@query("x44_decade_label", "select o_orderkey, (year(o_orderdate) // 10 * 10) || 's' as label from orders")
def x44(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", F.concat(D.decade(F.year("o_orderdate")).cast("string"), F.lit("s")).alias("label"))


@query("x45_years_in_text", r"select doc_id, list_sort(list_distinct(list_filter(regexp_extract_all(text || ' 1950s 1874, x1999 12000', '[0-9A-Za-z_]+'), lambda w: regexp_full_match(w, '1[89][0-9][0-9]s?')))) as years from documents")
def x45(spark, sf):
    w = r"(?<![0-9A-Za-z_])(1[89][0-9][0-9]s?)(?![0-9A-Za-z_])"
    found = F.regexp_extract_all(F.concat("text", F.lit(" 1950s 1874, x1999 12000")), F.lit(w), 1)
    return docs(spark, sf).select("doc_id", F.array_sort(F.array_distinct(found)).alias("years"))


BANDS = [(10.0, 2), (20.0, 4), (35.0, 7), (45.0, 9)]


@query(
    "x50_band_scores",
    """select p_partkey, case when p_size >= 45 then 9 when p_size >= 35 then 7 when p_size >= 20 then 4 when p_size >= 10 then 2 else 0 end as step,
    round(case when p_size >= 45 then 9 + 1 - 45.0 / p_size when p_size >= 35 then 7 + (p_size - 35) / 10.0 * 2 when p_size >= 20 then 4 + (p_size - 20) / 15.0 * 3 when p_size >= 10 then 2 + (p_size - 10) / 10.0 * 2 else p_size / 10.0 * 2 end, 6)::double as fine from part""",
)
def x50(spark, sf):
    v = F.col("p_size").cast("double")
    return load(spark, sf, "part").select("p_partkey", G.band_score(v, BANDS).alias("step"), F.round(G.fine_score(v, BANDS), 6).alias("fine"))


@query("x51_composite", "select d.doc_id, coalesce(least(case when quality = 1 then 8.0 end, case when toxic is not null then 10.0 - 6 * toxic end), 10.0)::double as score from documents d left join labels l on d.doc_id = l.doc_id")
def x51(spark, sf):
    a = F.when(F.col("quality") == 1, 8.0)
    b = F.when(F.col("toxic").isNotNull(), 10.0 - 6 * F.col("toxic"))
    return docs(spark, sf).join(load(spark, sf, "labels"), "doc_id", "left").select("doc_id", G.composite([a, b]).alias("score"))


@query("x52_geometric_blend", "select p_partkey, round(exp(0.7 * ln(greatest(p_size / 10.0, 1.0)) + 0.3 * ln(greatest(p_retailprice / 100, 1.0))), 6) as score from part")
def x52(spark, sf):
    return load(spark, sf, "part").select("p_partkey", F.round(G.blend(F.col("p_size") / 10, F.col("p_retailprice") / 100, 0.7), 6).alias("score"))


GRID_SQL = """grid as (select t as tier, w, (t * t // w) // 16 * 16 as h from (values (512), (768), (1024)) x(t), (select unnest(range(256, 1040, 16)) as w) where w >= t // 2 // 16 * 16 and w < t + 16),
  sizes as (select tier, w, h from grid union select tier, h, w from grid), fam(name, r, i) as (values ('9:16', 0.5647::double, 0), ('2:3', 0.6667, 1), ('4:5', 0.8028, 2), ('1:1', 1.0, 3), ('5:4', 1.2456, 4), ('3:2', 1.5, 5), ('16:9', 1.7708, 6)),
  bucket as (select tier, name, w as bw, h as bh from (select *, row_number() over (partition by tier, name order by abs(w / h - r), w, h) as k from sizes, fam) where k = 1),
  pic as (select p_partkey, (300 + p_size * 40)::bigint as w, (1100 - p_size * 9)::bigint as h from part),
  named as (select * from (select pic.*, name as family, row_number() over (partition by p_partkey order by abs(w / h - r), i) as k from pic, fam) where k = 1),
  cropped as (select n.*, tier, bw, bh, greatest(1, least(case when w / h > bw / bh then round_even(h * (bw / bh), 0) else w end, w))::bigint as cw, greatest(1, least(case when w / h > bw / bh then h else round_even(w / (bw / bh), 0) end, h))::bigint as ch from named n join bucket b on b.name = n.family),
  tiered as (select * from (select *, row_number() over (partition by p_partkey order by tier desc) as j from cropped where cw * ch >= bw * bh / (1.15 * 1.15)) where j = 1)"""


@query("x53_bucket_grid", f"with {GRID_SQL} select tier::int as resolution, w::int as width, h::int as height from sizes")
def x53(spark, sf):
    rows = [(r, w, h) for r in G.TIERS for w, h in G.bucket_grid(r)]
    return spark.createDataFrame(rows, "resolution int, width int, height int")


def pictures(spark, sf):
    return load(spark, sf, "part").select("p_partkey", (300 + F.col("p_size") * 40).cast("long").alias("w"), (1100 - F.col("p_size") * 9).cast("long").alias("h"))


@query(
    "x54_crop_geometry",
    f"with {GRID_SQL} select p_partkey, tier::int as tier, bw::int as bw, bh::int as bh, cw, ch, floor((w - cw) / 2)::bigint as x, floor((h - ch) * case when bw / bh < 1 then 1.0::double / 3 else 0.5 end)::bigint as y, round(1 - (cw * ch)::double / (w * h), 6) as cost from tiered",
)
def x54(spark, sf):
    p = pictures(spark, sf).withColumn("t", G.assign_tier(F.col("w"), F.col("h"))).where(F.col("t").isNotNull()).select("p_partkey", "w", "h", "t.*")
    x, y = G.crop_box(F.col("w"), F.col("h"), F.col("cw"), F.col("ch"), F.col("bw") / F.col("bh"))
    return p.select("p_partkey", "tier", "bw", "bh", "cw", "ch", x.alias("x"), y.alias("y"), F.round(G.crop_cost(F.col("w"), F.col("h"), F.col("cw"), F.col("ch")), 6).alias("cost"))


@query("x55_aspect_family", f"with {GRID_SQL} select p_partkey, family from named")
def x55(spark, sf):
    return pictures(spark, sf).select("p_partkey", G.nearest_family(F.col("w") / F.col("h")).alias("family"))


@query("x56_area_limit", "with s as (select p_partkey, 300 + p_size * 20 as w, 900 as h from part) select p_partkey, case when w * h <= 500000 then w else floor(w * sqrt(500000.0 / (w * h))) end::bigint as w, case when w * h <= 500000 then h else floor(h * sqrt(500000.0 / (w * h))) end::bigint as h from s")
def x56(spark, sf):
    w, h = G.limit_area((300 + F.col("p_size") * 20).cast("long"), F.lit(900).cast("long"), 500_000)
    return load(spark, sf, "part").select("p_partkey", w.alias("w"), h.alias("h"))


@query("x57_quantisation_quality", "select p_partkey, p_size + 40 as q from part")
def x57(spark, sf):
    base = [16, 11, 10, 16, 24, 40, 51, 61]
    q = (F.col("p_size") + 40).cast("int")
    s = F.when(q < 50, F.floor(F.lit(5000) / q)).otherwise(200 - 2 * q)
    table = F.array(*[F.least(F.lit(255), F.greatest(F.lit(1), F.floor((F.lit(v) * s + 50) / 100))) for v in base])
    sizes = load(spark, sf, "part").select("p_size").distinct().withColumn("q", G.jpeg_quality(table, base))
    return load(spark, sf, "part").select("p_partkey", "p_size").join(sizes, "p_size").select("p_partkey", "q")


@query("x60_softmax_mass", "with e as (select vec_id, embedding::double[] as v from embeddings), x as (select vec_id, list_transform(v, lambda a: exp(a - list_max(v))) as s from e) select vec_id, round(list_sum(s[1:5]) / list_sum(s), 6) as mass from x")
def x60(spark, sf):
    v = F.transform("embedding", lambda a: a.cast("double"))
    return load(spark, sf, "embeddings").select("vec_id", F.round(G.softmax_mass(v, 5), 6).alias("mass"))


@query("x61_logistic_stack", "select p_partkey, round(case when p_size % 5 = 0 then 1 / (1 + exp(-(p_size - 25) / 10.0)) else 1 / (1 + exp(-(0.1 + 0.8 * ((p_size - 25) / 10.0) + 0.5 * greatest((p_retailprice - 1000) / 100, 0.0)))) end, 6) as p from part")
def x61(spark, sf):
    logit = (F.col("p_size") - 25) / 10.0
    other = F.when(F.col("p_size") % 5 != 0, F.col("p_retailprice"))
    return load(spark, sf, "part").select("p_partkey", F.round(G.stacked(logit, other, 1000, 100, (0.1, 0.8, 0.5)), 6).alias("p"))


@query("x62_box_containment", "with b as (select l_orderkey, l_linenumber, l_partkey, l_quantity as x1, l_quantity + 10 as x2, l_discount * 100 as y1, l_discount * 100 + 8 as y2 from lineitem) select l_orderkey, l_linenumber, l_partkey, round(greatest(0, least(x2, 40) - greatest(x1, 15)) * greatest(0, least(y2, 12) - greatest(y1, 3)) / ((x2 - x1) * (y2 - y1)), 6) as share from b")
def x62(spark, sf):
    box = lambda a, b, c, d: F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2"))
    q, y = F.col("l_quantity"), F.col("l_discount") * 100
    inner = box(q, y, q + 10, y + 8)
    outer = box(F.lit(15.0), F.lit(3.0), F.lit(40.0), F.lit(12.0))
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(G.inside_share(inner, outer), 6).alias("share"))


@query("x63_colour_decision", "select p_partkey, case when p_retailprice < 1000 then 'bw' when p_retailprice > 1500 then 'color' else 'probe' end as mode from part")
def x63(spark, sf):
    return load(spark, sf, "part").select("p_partkey", G.colour_decision(F.col("p_retailprice"), 1000, 1500).alias("mode"))


@query("x64_colour_veto", "select l_orderkey, l_linenumber, l_partkey, greatest(l_quantity, l_tax * 100) >= 8 and least(l_quantity, l_tax * 100) < 0.25 * greatest(l_quantity, l_tax * 100) as veto from lineitem")
def x64(spark, sf):
    from sievework.operators.similarity import colour_veto

    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", colour_veto(F.col("l_quantity"), F.col("l_tax") * 100).alias("veto"))


@query("x70_json_round_trip", "select event_id, (props::json->>'k')::int as k, '{\"id\":' || event_id || ',\"type\":\"' || event_type || '\"}' as doc from events")
def x70(spark, sf):
    e = load(spark, sf, "events")
    return e.select("event_id", F.from_json("props", "k int")["k"].alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("doc"))


@query("x71_json_strings", "select event_id, [event_type, props, event_type] as strings from events")
def x71(spark, sf):
    doc = F.to_json(F.struct("event_type", F.struct(F.col("props").alias("deep"), F.array("event_type").alias("list")).alias("inner")))
    return load(spark, sf, "events").select("event_id", X.json_strings(doc).alias("strings"))


@query("x72_drop_paths")
def x72(spark, sf):
    doc = F.to_json(F.struct("event_type", F.lit("C:\\data\\x.jpg").alias("file"), F.lit("/home/u/y").alias("dir")))
    return load(spark, sf, "events").select("event_id", X.drop_paths(doc).alias("doc"))


@query("x73_first_json", "select event_id, replace(props, ': ', ':') as doc from events")
def x73(spark, sf):
    reply = F.concat(F.lit("Sure [not json]: ```json\n"), "props", F.lit("\n``` and {\"x\":1}"))
    return load(spark, sf, "events").select("event_id", X.first_json(F.replace(reply, F.lit("[not json]"), F.lit("(ok)"))).alias("doc"))


@query("x74_reply_map", "select user_id, event_type, arg_min(value, event_id) as value from events where event_type <> 'error' group by 1, 2")
def x74(spark, sf):
    e = load(spark, sf, "events").where(F.col("event_type") != "error")
    first = e.groupBy("user_id", "event_type").agg(F.min_by("value", "event_id").alias("value"))
    m = first.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "value"))).alias("m"))
    return m.select("user_id", F.explode("m").alias("event_type", "value"))


@query("x75_edit_json_field", "select event_id, '{\"k\":' || ((props::json->>'k')::int + 1) || ',\"tag\":\"x\"}' as props from events")
def x75(spark, sf):
    s = F.from_json("props", "k int")
    return load(spark, sf, "events").select("event_id", F.to_json(s.withField("k", s["k"] + 1).withField("tag", F.lit("x"))).alias("props"))


@query("x76_distinct_attachments", "select l_orderkey, count(distinct (l_partkey, l_suppkey)) as n from lineitem group by 1")
def x76(spark, sf):
    posts = load(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.collect_list(F.struct("l_partkey", "l_suppkey")).alias("photos"))
    chain = posts.groupBy("l_orderkey").agg(F.array_distinct(F.flatten(F.collect_list("photos"))).alias("photos"))
    return chain.select("l_orderkey", F.size("photos").cast("long").alias("n"))


@query("x77_ancestor_path", "select n_nationkey, [n_regionkey + 1000, n_nationkey] as path from nation")
def x77(spark, sf):
    return load(spark, sf, "nation").select("n_nationkey", F.concat(F.coalesce(F.array(F.col("n_regionkey") + 1000), F.array()), F.array("n_nationkey")).alias("path"))


@query("x78_content_keys", "select doc_id, sha256(text) as sha256, md5(text) as md5, sha1(text) as sha1 from documents")
def x78(spark, sf):
    return docs(spark, sf).select("doc_id", F.sha2("text", 256).alias("sha256"), F.md5("text").alias("md5"), F.sha1("text").alias("sha1"))


@query("x79_order_free_key", "select l_orderkey, l_linenumber, l_partkey, case when sha256(l_partkey::varchar) < sha256(l_suppkey::varchar) then left(sha256(l_partkey::varchar), 16) || '|' || left(sha256(l_suppkey::varchar), 16) else left(sha256(l_suppkey::varchar), 16) || '|' || left(sha256(l_partkey::varchar), 16) end as key from lineitem")
def x79(spark, sf):
    from sievework.operators.similarity import order_free_key

    k = lambda c: F.left(F.sha2(F.col(c).cast("string"), 256), F.lit(16))
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", order_free_key(k("l_partkey"), k("l_suppkey")).alias("key"))


@query("x80_signed_fold", "with h as (select doc_id, ('0x' || left(sha256(text), 16))::ubigint::hugeint as u from documents) select doc_id, (case when u >= 9223372036854775808 then u - 18446744073709551616 else u end)::bigint as h from h")
def x80(spark, sf):
    from sievework.operators.similarity import unsigned_hex_to_long

    return docs(spark, sf).select("doc_id", unsigned_hex_to_long(F.left(F.sha2("text", 256), F.lit(16))).alias("h"))
