"""Keys and text functions over driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.functions import keys as K
from duelframe.functions import text as T
from duelframe.operators.joins import broadcast_if_small
from duelframe.plans import sqlx as S
from duelframe.plans.registry import register, table


@register("name_keys", f"""
SELECT doc_id, pos, {S.normalize_name("a")} AS name_a, {S.normalize_name("b")} AS name_b,
       {S.pair_key(S.normalize_name("a"), S.normalize_name("b"))} AS pair_key
FROM {S.word_pairs("documents", "doc_id")}
""")
def q_name_keys(spark, sf_dir):
    """F1 + F2 + F3: every two neighbouring words of each document as two names."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(K.name_pairs("text")).alias("pos", "w")).select(
        "doc_id", "pos", F.col("w.a").alias("name_a"), F.col("w.b").alias("name_b"))
    return d.withColumn("pair_key", K.pair_key("name_a", "name_b"))


_LOC = "concat(n_name, ' Île', ', Centre, ', r_name)"


@register("place_keys", f"""
SELECT n_nationkey, {_LOC} AS location, {S.place_key(_LOC)} AS place_key,
       string_split(lower({S.strip_ws(_LOC)}), ', ')[1] AS city,
       string_split(lower({S.strip_ws(_LOC)}), ', ')[-1] AS country,
       {S.expand_abbreviations("concat(n_name, ' U.S. U.K.')")} AS expanded,
       CASE WHEN lower(replace(r_name, '.', '')) = 'us' THEN 'usa'
            ELSE {S.strip_ws("lower(replace(r_name, '.', ''))")} END AS country_code
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def q_place_keys(spark, sf_dir):
    """F4 + F5 + F8 on nation locations."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # region has 5 rows at every scale factor (fixed-size dimension)
    j = n.join(broadcast_if_small(r), n.n_regionkey == r.r_regionkey)
    loc = F.expr(_LOC)
    return j.select(
        "n_nationkey", loc.alias("location"), K.place_key(loc).alias("place_key"),
        K.city_of(loc).alias("city"), K.country_of(loc).alias("country"),
        K.expand_abbreviations(F.concat("n_name", F.lit(" U.S. U.K."))).alias("expanded"),
        K.country_code(F.lower("r_name")).alias("country_code"))


@register("number_text", """
WITH t AS (SELECT l_orderkey, l_linenumber,
                  concat('Elevation ', format('{:,.2f}', l_extendedprice), ' m (approx)') AS txt,
                  concat(CAST(l_quantity AS VARCHAR), ' m') AS qtxt
           FROM lineitem)
SELECT l_orderkey, l_linenumber,
       TRY_CAST(replace(regexp_extract(lower(txt), '([\\d]+|[\\d\\,\\d]+|[\\d\\.\\d]+|[\\d\\,]+[\\.\\d]+)(\\sm)', 1), ',', '') AS DOUBLE) AS elevation,
       TRY_CAST(replace(regexp_extract(lower(qtxt), '([\\d]+|[\\d\\,\\d]+|[\\d\\.\\d]+|[\\d\\,]+[\\.\\d]+)(\\sm)', 1), ',', '') AS DOUBLE) AS quantity,
       regexp_replace(txt, '[^0-9]', '', 'g') AS digits,
       regexp_replace(txt, '[^.0-9]', '', 'g') AS digits_dot,
       TRY_CAST(nullif(regexp_replace(CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE qtxt END, '\\D', '', 'g'), '') AS BIGINT) AS int_or_null
FROM t
""")
def q_number_text(spark, sf_dir):
    """F6 + F7 + P16: numbers formatted into text and parsed back."""
    from duelframe.operators.project import int_or_null

    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("Elevation "), F.format_number("l_extendedprice", 2),
                 F.lit(" m (approx)")).alias("txt"),
        F.concat(F.col("l_quantity").cast("string"), F.lit(" m")).alias("qtxt"))
    return li.select(
        "l_orderkey", "l_linenumber",
        K.elevation_m("txt").alias("elevation"), K.elevation_m("qtxt").alias("quantity"),
        K.digits_only("txt").alias("digits"), K.digits_and_dot("txt").alias("digits_dot"),
        int_or_null(F.when(F.col("l_linenumber") % 3 == 0, F.lit("")).otherwise(F.col("qtxt")))
        .alias("int_or_null"))


@register("date_text", """
SELECT o_orderkey,
       CAST(strptime(trim(concat('  ', strftime(o_orderdate, '%Y-%m-%d'), ' ')), '%Y-%m-%d') AS DATE) AS d_ymd,
       CAST(strptime(strftime(o_orderdate, '%b %-d, %Y'), '%b %d, %Y') AS DATE) AS d_mdy,
       CAST(o_orderdate AS DATE) + 1 AS d_next
FROM orders
""")
def q_date_text(spark, sf_dir):
    """F14 + F15 + F16: dates as text, parsed back; next day."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("  "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" ")).alias("t1"),
        F.date_format("o_orderdate", "MMM d, yyyy").alias("t2"),
        F.col("o_orderdate").cast("date").alias("d"))
    return o.select("o_orderkey", K.parse_ymd("t1").alias("d_ymd"),
                    K.parse_mdy("t2").alias("d_mdy"), K.add_days("d", 1).alias("d_next"))


# Hand cases for the outcome text (FIXTURES.md); order = o_orderkey % 9.
OUTCOME_CASES = [
    "decision", "decision (unanimous)", "decision (unanimous) (29-28, 30-27)",
    "tko (punches)", "dq (illegal knee)", "technical submission (choke)",
    "submission (rear-naked choke)", "referee stoppage", "no contest (overturned)",
]
_CASE_SQL = "CASE o_orderkey % 9 " + " ".join(
    f"WHEN {i} THEN {S.lit(t)}" for i, t in enumerate(OUTCOME_CASES)) + " END"

_METHOD_SQL = """(CASE WHEN m1 = 'dq' THEN 'disqualification' ELSE m1 END)"""


@register("outcome_text", f"""
WITH t AS (SELECT o_orderkey, {_CASE_SQL} AS win_condition, o_custkey FROM orders),
m AS (SELECT *, CASE WHEN contains(win_condition, 'decision') THEN 'decision'
                     ELSE trim(string_split(win_condition, ' (')[1]) END AS m1,
             string_split(win_condition, ' (') AS parts,
             list_filter(string_split_regex(regexp_replace(win_condition, '[^a-z ]+', '', 'g'), ' +'), lambda w: w <> '') AS words
      FROM t),
d AS (SELECT *, CASE WHEN contains(win_condition, 'decision') THEN
                  CASE WHEN win_condition = 'decision' THEN ''
                       WHEN len(parts) < 3 THEN trim(regexp_replace(trim(replace(win_condition, 'decision', '')), '[^a-z ]+', '', 'g'))
                       ELSE trim(regexp_replace(parts[3], '[()]+', '', 'g')) END
                ELSE array_to_string(words[2:], ' ') END AS d1
      FROM m)
SELECT o_orderkey, win_condition,
       trim(CASE WHEN contains({_METHOD_SQL}, 'referee stoppage') THEN 'tko'
            WHEN contains({_METHOD_SQL}, 'submission') THEN 'submission'
            ELSE {_METHOD_SQL} END) AS method,
       trim(replace(replace(replace(d1, 'dq', ''), 'submission', ''), 'disqualification', '')) AS detail,
       regexp_replace(concat('Name ', CAST(o_custkey AS VARCHAR), ' (nick) x'), '\\(.*?\\)', '', 'g') AS stripped
FROM d
""")
def q_outcome_text(spark, sf_dir):
    """F9 + F10 + F11 on synthesised outcome text."""
    o = table(spark, sf_dir, "orders")
    wc = F.element_at(F.array(*[F.lit(t) for t in OUTCOME_CASES]),
                      (F.col("o_orderkey") % 9 + 1).cast("int"))
    t = o.select("o_orderkey", "o_custkey", wc.alias("win_condition"))
    return t.select(
        "o_orderkey", "win_condition",
        T.outcome_method("win_condition").alias("method"),
        T.outcome_detail("win_condition").alias("detail"),
        T.strip_parens(F.concat(F.lit("Name "), F.col("o_custkey").cast("string"),
                                F.lit(" (nick) x"))).alias("stripped"))


@register("text_tests", """
SELECT page_id, contains(url, 'https') AS is_https, url = '' AS url_blank,
       length(regexp_replace(url, '[^/]', '', 'g')) = 0 AS no_slash,
       concat('https://example.org', regexp_extract(html, 'href="([^"]*)"', 1)) AS first_link,
       CAST(to_json({'page_id': page_id, 'n': length(url)}) AS VARCHAR) AS record
FROM pages
""")
def q_text_tests(spark, sf_dir):
    """F22 + F23 + F24 on pages."""
    p = table(spark, sf_dir, "pages")
    return p.select(
        "page_id", F.col("url").contains("https").alias("is_https"),
        T.is_blank("url").alias("url_blank"),
        T.is_blank(F.regexp_replace("url", "[^/]", "")).alias("no_slash"),
        T.absolute_url("https://example.org",
                       F.regexp_extract("html", 'href="([^"]*)"', 1)).alias("first_link"),
        T.row_json(F.col("page_id"), F.length("url").alias("n")).alias("record"))
