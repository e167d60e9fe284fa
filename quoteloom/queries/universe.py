"""Queries over symbols, index membership and choices."""

from __future__ import annotations

from pyspark.sql import functions as F

from quoteloom.functions.choices import FLAG_NAMES, KNOWN_INDEXES, choice_map, known_key
from quoteloom.functions.symbols import clean_symbol, index_names, known_index_key
from quoteloom.functions.text import boolean, dash_list
from quoteloom.operators.info import info, provider_info
from quoteloom.operators.universe import (
    by_choice,
    by_every_choice,
    clean_batch_symbols,
    clean_symbols,
    clean_web_symbols,
    flag_columns,
    flag_table,
    membership,
    members_per_index,
    normalise_headers,
    preview,
    sample_symbols,
    top_indexes,
    union_lists,
)
from quoteloom.plans.universe import index_lists
from quoteloom.queries import inputs as i
from quoteloom.queries.registry import query


@query(
    "clean_symbols",
    "P1a P1d P18 F1",
    f"WITH {i.UNIVERSE_SQL} SELECT symbol, pos FROM cleaned WHERE symbol IS NOT NULL",
)
def clean_symbols_query(spark, sf):
    return clean_symbols(i.raw_symbols(spark, sf))


@query(
    "clean_symbols_batch",
    "P1b W1 J3 N2",
    f"""WITH {i.UNIVERSE_SQL}
    SELECT symbol, min(pos) AS pos FROM cleaned
    WHERE symbol IS NOT NULL AND lower(trim(raw_symbol)) <> 'nan'
      AND symbol NOT IN (SELECT symbol FROM cleaned WHERE symbol IS NOT NULL AND sector = 'STANDARD')
    GROUP BY symbol""",
)
def clean_symbols_batch(spark, sf):
    rejects = i.table(spark, sf, "part").filter("p_type = 'STANDARD'").select(
        clean_symbol(F.expr(i._RAW_SYMBOL)).alias("symbol")
    )
    return clean_batch_symbols(i.raw_symbols(spark, sf), "pos", rejects.filter("symbol IS NOT NULL"))


@query(
    "clean_symbols_web",
    "P1c",
    f"""WITH {i.UNIVERSE_SQL}
    SELECT symbol, pos FROM cleaned
    WHERE raw_symbol IS NULL OR (symbol IS NOT NULL AND strpos(symbol, '\\') = 0)""",
)
def clean_symbols_web(spark, sf):
    return clean_web_symbols(i.raw_symbols(spark, sf))


@query(
    "universe_normalised",
    "S2 P2 P18 B11 W1",
    f"""WITH {i.UNIVERSE_SQL}
    SELECT symbol, description, market_cap, 'USD' AS market_cap_currency, sector, industry, exchange,
           index_text AS "index", pos FROM universe""",
)
def universe_normalised(spark, sf):
    return i.universe(spark, sf).drop("indexes")


@query(
    "symbol_sample",
    "O9",
    f"WITH {i.UNIVERSE_SQL} SELECT symbol FROM universe ORDER BY md5(concat('7', symbol)), symbol LIMIT 5",
)
def symbol_sample(spark, sf):
    return sample_symbols(i.universe(spark, sf), 5, "7")


@query(
    "universe_preview",
    "O10",
    f"WITH {i.UNIVERSE_SQL} SELECT symbol, description, pos FROM universe ORDER BY pos LIMIT 5",
)
def universe_preview(spark, sf):
    return preview(i.universe(spark, sf)).select("symbol", "description", "pos")


@query("index_membership", "M5 F2 F3 F5", f"WITH {i.MEMBERSHIP_SQL} SELECT * FROM membership")
def index_membership(spark, sf):
    return membership(i.universe(spark, sf))


@query("index_counts", "A1", f"WITH {i.MEMBERSHIP_SQL} SELECT index_key, count(*) AS members FROM membership GROUP BY index_key")
def index_counts(spark, sf):
    return members_per_index(membership(i.universe(spark, sf)))


@query(
    "index_counts_top10",
    "A1 O5",
    f"""WITH {i.MEMBERSHIP_SQL} SELECT index_key, count(*) AS members FROM membership
    GROUP BY index_key ORDER BY members DESC, index_key LIMIT 10""",
)
def index_counts_top10(spark, sf):
    return top_indexes(membership(i.universe(spark, sf)))


_FOUND_KEYS = sorted(
    ["SP500", "Russell1000", "Russell3000", "SPMidCap400", "Russell2000", "NASDAQ100", "NASDAQComposite", "NASDAQBank"]
    + [f"Brand#{n}" for n in range(1, 26) if n != 7]  # symbols of Brand#7 have a slash
)


@query(
    "index_flags_wide",
    "A6 F5",
    f"WITH {i.MEMBERSHIP_SQL} SELECT u.symbol, "
    + ", ".join(f"coalesce(bool_or(index_key = '{k}'), FALSE) AS \"{k}\"" for k in _FOUND_KEYS)
    + " FROM universe u LEFT JOIN membership m ON u.symbol = m.symbol GROUP BY u.symbol",
)
def index_flags_wide(spark, sf):
    """The keys are found in the data, not given."""
    return flag_columns(i.universe(spark, sf).select("symbol", "indexes")).drop("indexes")


@query(
    "index_flags_fixed",
    "A7 P15 O3 F3 K5",
    f"""WITH {i.UNIVERSE_SQL}, named AS (
      SELECT symbol, [trim(x) FOR x IN string_split(coalesce(index_text, ''), ',')] AS names FROM universe)
    SELECT symbol, description, market_cap, 'USD' AS market_cap_currency, sector, industry, exchange,
           index_text AS "index", """
    + ", ".join(f"list_contains(names, '{n}') AS \"{known_key(n)}\"" for n in KNOWN_INDEXES)
    + " FROM universe JOIN named USING (symbol) ORDER BY symbol",
)
def index_flags_fixed(spark, sf):
    return flag_table(i.universe(spark, sf).drop("pos"))


@query(
    "index_lists",
    "K6 F4",
    f"""WITH {i.MEMBERSHIP_SQL} SELECT symbol, index_key FROM membership
    WHERE index_key IN ('SP500', 'NASDAQ100', 'NASDAQComposite', 'Russell1000', 'Russell3000', 'Russell2000', 'SPMidCap400')""",
)
def index_lists_query(spark, sf):
    return index_lists(i.universe(spark, sf))


@query(
    "index_key_names",
    "F4 F15",
    f"""WITH {i.UNIVERSE_SQL}, named AS (
      SELECT trim(unnest(string_split(index_text, ','))) AS index_name FROM universe)
    SELECT DISTINCT index_name, translate(index_name, ' &', '') AS index_key FROM named WHERE index_name <> ''""",
)
def index_key_names(spark, sf):
    names = i.universe(spark, sf).select(F.explode(index_names(F.col("index"))).alias("index_name")).distinct()
    return names.withColumn("index_key", known_index_key(F.col("index_name")))


def _flags_sql(flags: list[str]) -> str:
    if not flags:
        return "SELECT symbol, market_cap, sector FROM universe"
    listed = ", ".join(f"'{f}'" for f in flags)
    return (
        "SELECT symbol, market_cap, sector FROM universe WHERE symbol IN "
        f"(SELECT symbol FROM membership WHERE index_key IN ({listed}))"
    )


@query(
    "universe_by_choice",
    "P11 Q5 F15 B7",
    f"WITH {i.MEMBERSHIP_SQL}, picked AS ("
    + " UNION ALL ".join(f"SELECT {c} AS choice, * FROM ({_flags_sql(f)})" for c, f in FLAG_NAMES.items())
    + ") SELECT * FROM picked",
)
def universe_by_choice(spark, sf):
    return by_every_choice(i.universe(spark, sf)).select("choice", "symbol", "market_cap", "sector")


@query(
    "choice_members",
    "F15 M10 B7",
    f"""WITH {i.MEMBERSHIP_SQL}, flags(choice, key) AS (VALUES """
    + ", ".join(f"({c}, '{k}')" for c, keys in FLAG_NAMES.items() for k in keys)
    + """) SELECT choice, index_key, count(*) AS members FROM membership JOIN flags ON index_key = key GROUP BY ALL""",
)
def choice_members(spark, sf):
    """Members per choice and flag, through the choice table as a dimension of fixed size."""
    flags = choice_map(spark).filter("kind = 'flags'").select("choice", F.col("key").alias("index_key"))
    counts = members_per_index(membership(i.universe(spark, sf)))
    return counts.join(flags, "index_key").select("choice", "index_key", "members")


@query("universe_single_choice", "P11", f"WITH {i.MEMBERSHIP_SQL} {_flags_sql(FLAG_NAMES[13])}")
def universe_single_choice(spark, sf):
    return by_choice(i.universe(spark, sf), 13).select("symbol", "market_cap", "sector")


@query("universe_multi_choice", "P12 F13", f"WITH {i.MEMBERSHIP_SQL} {_flags_sql(['SP500', 'Russell1000'])}")
def universe_multi_choice(spark, sf):
    return by_choice(i.universe(spark, sf), "1-4").select("symbol", "market_cap", "sector")


@query(
    "symbol_list_union",
    "U5 W1 M10 Q5",
    f"""WITH {i.UNIVERSE_SQL}, listed AS (
      SELECT symbol, 0 AS list, pos FROM cleaned WHERE sector = 'LARGE'
      UNION ALL SELECT symbol, 1, pos FROM cleaned WHERE sector = 'PROMO'
      UNION ALL SELECT symbol, 2, pos FROM cleaned WHERE exchange = 'NYSE')
    SELECT symbol, list, pos FROM listed WHERE symbol IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY list, pos) = 1""",
)
def symbol_list_union(spark, sf):
    rows = clean_symbols(normalise_headers(i.raw_universe(spark, sf)))
    lists = [rows.filter(c).select("symbol", "pos") for c in ("sector = 'LARGE'", "sector = 'PROMO'", "exchange = 'NYSE'")]
    step = F.lit("1000000000000000000000000").cast("decimal(38,0)")
    pos = F.col("pos")
    return union_lists(lists).select(
        "symbol", F.expr("cast(pos div 1000000000000000000000000BD as int)").alias("list"),
        (pos % step).cast("bigint").alias("pos"),
    )


@query(
    "symbol_set_union",
    "U8",
    f"""WITH {i.MEMBERSHIP_SQL} SELECT symbol FROM membership WHERE index_key = 'SP500'
    UNION SELECT symbol FROM membership WHERE index_key = 'NASDAQ100'""",
)
def symbol_set_union(spark, sf):
    members = membership(i.universe(spark, sf))
    one = members.filter("index_key = 'SP500'").select("symbol")
    return one.union(members.filter("index_key = 'NASDAQ100'").select("symbol")).distinct()


@query(
    "symbol_set_intersection",
    "U7",
    f"""WITH {i.MEMBERSHIP_SQL} SELECT symbol FROM membership WHERE index_key = 'SP500'
    INTERSECT SELECT symbol FROM membership WHERE index_key = 'Russell1000'""",
)
def symbol_set_intersection(spark, sf):
    members = membership(i.universe(spark, sf))
    return members.filter("index_key = 'SP500'").select("symbol").intersect(
        members.filter("index_key = 'Russell1000'").select("symbol")
    )


@query(
    "info_projection",
    "P13 B3 N3",
    f"""WITH {i.UNIVERSE_SQL}
    SELECT symbol, description, market_cap AS market_capitalization, 'USD' AS market_cap_currency, sector,
           industry, exchange, CAST(NULL AS VARCHAR) AS analyst_rating,
           CAST(NULL AS VARCHAR) AS upcoming_earnings_date, CAST(NULL AS VARCHAR) AS recent_earnings_date
    FROM universe""",
)
def info_projection(spark, sf):
    return info(i.universe(spark, sf))


@query(
    "provider_info",
    "P14 K12",
    f"""WITH {i.UNIVERSE_SQL}
    SELECT symbol, description AS "longName", sector, industry, exchange, market_cap AS "marketCap",
           CAST(NULL AS VARCHAR) AS "upcoming earnings", CAST(NULL AS VARCHAR) AS "recent earnings"
    FROM universe""",
)
def provider_info_query(spark, sf):
    return provider_info(i.universe(spark, sf))


@query(
    "text_flags_and_dash_lists",
    "F12 F13 F6",
    """SELECT p_partkey, lower(trim(flag)) IN ('true', '1', 'yes', 'on') AS flag,
              array_to_string([TRY_CAST(trim(x) AS INTEGER) FOR x IN string_split(dashed, '-') IF TRY_CAST(trim(x) AS INTEGER) IS NOT NULL], '-') AS choices
    FROM (SELECT p_partkey, CASE WHEN p_size < 10 THEN ' Yes ' WHEN p_size < 20 THEN 'TRUE'
                                 WHEN p_size < 30 THEN CAST(p_size - 19 AS VARCHAR) ELSE 'off' END AS flag,
                 concat(p_size, '-', p_type, '-', regexp_extract(p_brand, '([0-9]+)', 1)) AS dashed FROM part)""",
)
def text_flags_and_dash_lists(spark, sf):
    size = F.col("p_size")
    flag = (
        F.when(size < 10, " Yes ").when(size < 20, "TRUE")
        .when(size < 30, (size - 19).cast("string")).otherwise("off")
    )
    dashed = F.concat_ws("-", size.cast("string"), "p_type", F.regexp_extract("p_brand", "([0-9]+)", 1))
    return i.table(spark, sf, "part").select(
        "p_partkey", boolean(flag).alias("flag"),
        F.array_join(F.transform(dash_list(dashed), lambda x: x.cast("string")), "-").alias("choices"),
    )
