"""The same queries as plain SQL, for a check by another engine on the same tables."""

from __future__ import annotations

from ..functions.dates import CLOCK_SHAPE, DATE_FORMATS, GENERIC_SHAPE, TIME_ZONE_SHAPE
from .data import CODES, SUFFIXES
from .queries import LONG_IDS, SEARCH_WORDS, SHORT_IDS


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def array(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def entity(nation: str, key: str) -> str:
    return f"{array(CODES)}[{nation} % 8 + 1] || lpad(CAST({key} AS VARCHAR), 8, '0')"


ENTITIES = f"SELECT *, {entity('c_nationkey', 'c_custkey')} AS entity_id FROM customer"
FINANCIALS = f"""
SELECT o_orderkey, {entity('c_nationkey', 'c_custkey')} AS entity_id, o_orderdate AS closing_date,
       o_totalprice AS total_assets, o_orderstatus, o_orderpriority
FROM orders JOIN customer ON o_custkey = c_custkey"""
TEXT_DATES = f"""
SELECT o_orderkey, entity_id,
       CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderpriority = '5-LOW' THEN 'n/a'
            ELSE strftime(closing_date, '%Y-%m-%d %H:%M:%S') END AS closing_date,
       total_assets, o_orderstatus, o_orderpriority
FROM ({FINANCIALS})"""
TRADES = f"""
SELECT l_orderkey, l_linenumber, {entity('c_nationkey', 'c_custkey')} AS buyer_id,
       {entity('s_nationkey', 's_suppkey')} AS seller_id, l_extendedprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN supplier ON l_suppkey = s_suppkey"""
COUNTRY_CODES = f"SELECT n_name AS \"Country\", {array(CODES)}[n_nationkey % 8 + 1] AS \"Code\" FROM nation"
ENTRIES = """
SELECT DISTINCT c_mktsegment || '_exported ' || strftime(o_orderdate, '%Y-%m-%d_%H-%M-%S') AS export,
       c_mktsegment AS product, o_orderdate AS stamp, 'interim_usd_' || o_orderstatus AS tab
FROM orders JOIN customer ON o_custkey = c_custkey"""
CATALOG = f"""
SELECT product AS "Data Product", tab AS "Table", '/exports/' || export AS "Base Directory", stamp AS "Timestamp",
       '/exports/' || export AS "Export", export AS "Top-level Directory" FROM ({ENTRIES})"""
NEWEST = f"""
SELECT * FROM ({CATALOG}) WHERE ("Data Product", "Timestamp") IN
       (SELECT ("Data Product", max("Timestamp")) FROM ({CATALOG}) GROUP BY "Data Product")"""
DICTIONARY = """
SELECT DISTINCT p_brand AS "Data Product", p_type AS "Table", p_name AS "Column",
       p_name || ' of size ' || p_size AS "Definition" FROM part"""
HEADINGS = """
SELECT upper(replace(p_name, ' ', '-')) AS heading FROM part
UNION SELECT c_mktsegment FROM customer"""
TITLES = f"""
SELECT trim(regexp_extract(html, '<title>(.*?)</title>', 1) || ' ' || {array(SUFFIXES)}[page_id % 6 + 1]) AS name,
       page_id FROM pages"""
MISSPELLED = f"SELECT regexp_replace(name, '^(...).', '\\1') AS search FROM ({TITLES})"
REORDERED = f"SELECT array_to_string(list_reverse(string_split(name, ' ')), ' ') AS search FROM ({TITLES})"
CHANGES = """
SELECT c_mktsegment || '-' || c_custkey AS old_id,
       c_mktsegment || '-' || (c_custkey + c_nationkey
           + CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) AS new_id,
       o_orderdate AS change_date
FROM orders JOIN customer ON o_custkey = c_custkey"""


def letters(col: str) -> str:
    return f"regexp_replace(lower({col}), '[^a-zA-Z0-9]', '', 'g')"


def has(col: str, word: str) -> str:
    return f"contains(lower({col}), {lit(word.lower())})"


def any_has(word: str, columns=("Data Product", "Table", "Column", "Definition")) -> str:
    return "(" + " OR ".join(has(f'"{c}"', word) for c in columns) + ")"


def financials_where(test: str, base: str = FINANCIALS) -> str:
    return f"SELECT o_orderkey, entity_id, closing_date, total_assets FROM ({base}) WHERE {test}"


YEARS = "year(closing_date) BETWEEN 1996 AND 1998"


def text_years(keep: bool) -> str:
    test = "d IS NULL OR year(d) BETWEEN 1996 AND 1998" if keep else "year(d) BETWEEN 1996 AND 1998"
    return f"""SELECT o_orderkey, entity_id, d AS closing_date, total_assets
    FROM (SELECT *, try_cast(closing_date AS TIMESTAMP) AS d FROM ({TEXT_DATES})) WHERE {test}"""


def distribution(base: str, day: str) -> str:
    return f"""
    WITH y AS (SELECT year({day}) AS y, count(*) AS n FROM ({base}) WHERE {day} IS NOT NULL GROUP BY 1)
    SELECT CAST(y AS VARCHAR) AS "Year", CAST(n AS BIGINT) AS "Frequency",
           round(n / (SELECT sum(n) FROM y) * 100, 6) AS "Percentage" FROM y
    UNION ALL SELECT 'Total', CAST(sum(n) AS BIGINT), 100.0 FROM y"""


# lineage


SUCCESSOR = f"""
edges AS (SELECT old_id, new_id, max(change_date) AS change_date FROM ({CHANGES}) GROUP BY 1, 2),
step AS (SELECT old_id AS id, arg_max(new_id, (change_date, new_id)) AS next FROM edges GROUP BY 1),
pairs AS (SELECT old_id AS a, new_id AS b FROM edges UNION SELECT new_id, old_id FROM edges),
seeds AS (SELECT DISTINCT c_mktsegment || '-' || c_custkey AS id FROM customer WHERE c_acctbal < 0),
found AS (SELECT id FROM seeds UNION SELECT b FROM found JOIN pairs ON a = id),
walk AS (SELECT id, id AS tip FROM found UNION ALL
         SELECT w.id, s.next FROM walk w JOIN step s ON s.id = w.tip WHERE s.next <> w.tip),
newest AS (SELECT id, tip AS newest_id FROM walk w
           WHERE NOT EXISTS (SELECT 1 FROM step s WHERE s.id = w.tip AND s.next <> w.tip))"""


# profiles


def date_count(col: str, fmt) -> str:
    pattern = {"%Y-%m-%dT%H:%M:%SZ": "%Y-%m-%dT%H:%M:%SZ"}.get(fmt.name, fmt.name)
    return (f"count(*) FILTER (WHERE {col} IS NOT NULL AND regexp_matches({col}, {lit(fmt.shape)}) "
            f"AND year(try_strptime({col}, {lit(pattern)})) BETWEEN 1678 AND 2261)")


def profile_column(col: str, dtype: str, kind: str, total: int, base: str, product, table) -> str:
    """One profile row by direct aggregation."""
    def text(value):
        return "CAST(NULL AS VARCHAR)" if value is None else lit(value)

    native = kind in ("datetime", "date")
    counts = ", ".join(f"{date_count('t', f)} AS d{i}" for i, f in enumerate(DATE_FORMATS))
    ds = [f"d{i}" for i in range(len(DATE_FORMATS))]
    top = f"greatest({', '.join(ds)})"

    def pick(values):
        cases = " ".join(f"WHEN {d} = {top} THEN {v}" for d, v in zip(ds, values))
        return f"CASE {cases} END"

    def yes(flags):
        return ["true" if f else "false" for f in flags]

    source = f"""
    SELECT *, {top} AS top, greatest({top}, generic) AS best, generic > {top} AS mixed FROM (
      SELECT count(*) AS rows_, count(v) AS full_, count(DISTINCT v) AS uniq, min(length(v)) AS lo, max(length(v)) AS hi,
             avg(length(v)) AS mean_, count(*) FILTER (WHERE s <> '') AS filled,
             coalesce(bool_or(regexp_matches(v, '[A-Za-z0-9]')), false) AS alnum, {counts},
             count(*) FILTER (WHERE regexp_matches(t, {lit(GENERIC_SHAPE)})
                              AND year(try_cast(t AS TIMESTAMP)) BETWEEN 1678 AND 2261) AS generic,
             coalesce(bool_or(regexp_matches(t, {lit(TIME_ZONE_SHAPE)})), false) AS zone,
             coalesce(bool_or(regexp_matches(t, {lit(CLOCK_SHAPE)})), false) AS clock,
             count(*) FILTER (WHERE regexp_matches(bare, '^..[0-9]{{3,}}$') AND bare[1:2] IN {in_list(CODES)}) AS ids
      FROM (SELECT v, trim(v) AS s, CASE WHEN {'false' if native else 'true'} AND trim(v) <> '' THEN trim(v) END AS t,
                   regexp_replace(upper(trim(v)), '[\\s\\-_./]', '', 'g') AS bare
            FROM (SELECT CAST("{col}" AS VARCHAR) AS v FROM ({base}))))"""
    if native:
        dates = f"""'native' AS date_format, 1.0 AS date_format_confidence, false AS date_format_ambiguous,
          {lit(kind)} AS date_granularity, 1.0 AS date_parseable_pct, {'true' if kind == 'datetime' else 'false'} AS has_time_component,
          false AS has_timezone, 'native' AS date_filter_strategy"""
    else:
        share = "CASE WHEN best > 0 THEN best / filled ELSE 0.0 END"
        both = "(d4 = best AND d5 = best)"
        dates = f"""
          CASE WHEN best > 0 THEN CASE WHEN mixed THEN 'mixed' ELSE {pick([lit(f.name) for f in DATE_FORMATS])} END END AS date_format,
          {share} AS date_format_confidence,
          best > 0 AND ((NOT mixed AND {pick(yes(f.ambiguous for f in DATE_FORMATS))}) OR {both}) AS date_format_ambiguous,
          CASE WHEN best > 0 THEN CASE WHEN mixed THEN 'mixed' ELSE {pick([lit(f.granularity) for f in DATE_FORMATS])} END END AS date_granularity,
          {share} AS date_parseable_pct,
          best > 0 AND ((NOT mixed AND {pick(yes(f.has_time for f in DATE_FORMATS))}) OR clock) AS has_time_component,
          best > 0 AND zone AS has_timezone,
          CASE WHEN best > 0 THEN CASE WHEN mixed THEN 'mixed_or_inferred' ELSE 'parse_with_format:' || {pick([lit(f.name) for f in DATE_FORMATS])} END END AS date_filter_strategy"""
    logical = lit(kind) if kind != "text" else """CASE WHEN date_parseable_pct >= 0.9 THEN CASE WHEN date_granularity = 'datetime' THEN 'datetime' ELSE 'date' END
          WHEN full_ = 0 THEN 'unknown' WHEN unique_pct >= 0.8 AND alnum THEN 'identifier'
          WHEN unique_pct <= 0.2 THEN 'categorical' ELSE 'string' END"""
    return f"""
    SELECT data_product, "table", file_name, sample_strategy, sampled_rows, column_count, "column", physical_dtype, logical_type,
           nullable, non_null_count, missing_count, round(missing_pct, 6) AS missing_pct, unique_count,
           round(unique_pct, 6) AS unique_pct, string_min_length, string_max_length,
           round(string_mean_length, 6) AS string_mean_length, date_format,
           round(date_format_confidence, 6) AS date_format_confidence, date_format_ambiguous, date_granularity,
           round(date_parseable_pct, 6) AS date_parseable_pct, has_time_component, has_timezone, date_filter_strategy,
           entity_id_like_count, round(entity_id_like_pct, 6) AS entity_id_like_pct, contains_entity_id_like_values,
           mostly_entity_id_like, can_filter_exact, can_filter_prefix, can_groupby, can_join_key, can_numeric_aggregate,
           can_date_filter, needs_null_handling,
           concat_ws(';', CASE WHEN nullable THEN 'contains_nulls' END, CASE WHEN can_date_filter THEN 'date_filter_supported' END,
             CASE WHEN can_join_key THEN 'candidate_join_key' END, CASE WHEN can_numeric_aggregate THEN 'numeric_aggregation_supported' END,
             CASE WHEN logical_type = 'identifier' THEN 'candidate_identifier' END,
             CASE WHEN mostly_entity_id_like THEN 'candidate_entity_id_column' END) AS operation_notes
    FROM (SELECT *, logical_type <> 'unknown' AND full_ > 0 AS can_filter_exact,
                 logical_type IN ('string', 'identifier', 'categorical') AS can_filter_prefix,
                 logical_type IN ('categorical', 'identifier', 'string', 'boolean', 'date') AND unique_pct <= 0.5 AND full_ > 0 AS can_groupby,
                 logical_type IN ('identifier', 'integer', 'string') AND missing_pct <= 0.01 AND unique_pct >= 0.8 AS can_join_key,
                 logical_type IN ('integer', 'float') AND full_ > 0 AS can_numeric_aggregate,
                 logical_type IN ('date', 'datetime') AND (date_parseable_pct >= 0.9 OR coalesce(date_filter_strategy = 'native', false)) AS can_date_filter,
                 nullable AS needs_null_handling
          FROM (SELECT *, {logical} AS logical_type
                FROM (SELECT *, {text(product)} AS data_product, {text(table)} AS "table", CAST(NULL AS VARCHAR) AS file_name,
                             'all' AS sample_strategy, rows_ AS sampled_rows, {total} AS column_count, {lit(col)} AS "column",
                             {lit(dtype)} AS physical_dtype, rows_ > full_ AS nullable, full_ AS non_null_count,
                             rows_ - full_ AS missing_count, CASE WHEN rows_ > 0 THEN (rows_ - full_) / rows_ ELSE 0.0 END AS missing_pct,
                             uniq AS unique_count, CASE WHEN full_ > 0 THEN uniq / full_ ELSE 0.0 END AS unique_pct,
                             lo AS string_min_length, hi AS string_max_length, mean_ AS string_mean_length, {dates},
                             ids AS entity_id_like_count, CASE WHEN filled > 0 THEN ids / filled ELSE 0.0 END AS entity_id_like_pct,
                             ids > 0 AS contains_entity_id_like_values, ids > 0 AND ids / filled >= 0.8 AS mostly_entity_id_like
                      FROM ({source}))))"""


def profile_sql(base: str, columns: list[tuple[str, str, str]], product=None, table=None) -> str:
    return " UNION ALL ".join(
        profile_column(c, dtype, kind, len(columns), base, product, table) for c, dtype, kind in columns)


INT, LONG, TEXT = ("int", "integer"), ("bigint", "integer"), ("string", "text")
REAL, STAMP = ("double", "float"), ("timestamp_ntz", "datetime")


def typed(**columns) -> list[tuple[str, str, str]]:
    return [(name, *kind) for name, kind in columns.items()]


ORDER_COLUMNS = typed(o_orderkey=LONG, o_custkey=LONG, o_orderstatus=TEXT, o_totalprice=REAL, o_orderdate=STAMP, o_orderpriority=TEXT)
CUSTOMER_COLUMNS = typed(c_custkey=LONG, c_name=TEXT, c_nationkey=INT, c_acctbal=REAL, c_mktsegment=TEXT, entity_id=TEXT)
TRADE_COLUMNS = typed(l_orderkey=LONG, l_linenumber=INT, buyer_id=TEXT, seller_id=TEXT, l_extendedprice=REAL)
TEXT_DATE_COLUMNS = typed(o_orderkey=LONG, entity_id=TEXT, closing_date=TEXT, total_assets=REAL, o_orderstatus=TEXT, o_orderpriority=TEXT)
FORMS = {
    "iso": "%Y-%m-%d", "compact": "%Y%m%d", "month": "%Y-%m", "year": "%Y", "day_first": "%d/%m/%Y",
    "month_first": "%m/%d/%Y", "day_dash": "%d-%m-%Y", "full": "%Y-%m-%d %H:%M:%S",
    "full_t": "%Y-%m-%dT%H:%M:%S", "full_z": "%Y-%m-%dT%H:%M:%SZ"}
DATE_TEXTS = "SELECT " + ", ".join(f"strftime(closing_date, {lit(f)}) AS {n}" for n, f in FORMS.items()) + f" FROM ({FINANCIALS})"
OPERATION_LIST = (
    'data_product, "table", "column", logical_type, nullable, missing_pct, unique_pct, entity_id_like_pct, '
    "mostly_entity_id_like, can_filter_exact, can_filter_prefix, can_groupby, can_join_key, "
    "can_numeric_aggregate, can_date_filter, operation_notes")


# names


# The company suffixes as they are once cleaned, in matching order.
CLEANED_SUFFIXES = [
    "inc", "incorporated", "ltd", "limited", "llc", "plc", "corp", "corporation",
    "co", "company", "llp", "gmbh", "ag", "sa", "sas", "pty ltd", "bv", "oy", "as",
    "nv", "kk", "srl", "sp z oo", "sc", "ou",
    "inc", "ltd", "llc", "plc", "corp", "co", "llp", "gmbh", "ag", "s a",
    "s a s", "pty ltd", "b v", "oy", "a s", "n v", "k k", "s r l",
    "sp z o o", "s c", "oü",
]


def normalized(col: str, suffixes=CLEANED_SUFFIXES) -> str:
    clean = f"trim(regexp_replace(regexp_replace(lower({col}), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
    cases = " ".join(
        f"WHEN ends_with(n, {lit(s)}) THEN trim(n[1:length(n) - {len(s)}])" for s in suffixes)
    kept = f"CASE {cases} ELSE n END" if cases else "n"
    return f"(SELECT nullif({kept}, '') FROM (SELECT {clean} AS n))"


def lcs(a: str, b: str) -> str:
    """Longest common subsequence as a fold over the rows of its table."""
    return f"""list_reduce(string_split({a}, ''), lambda rw, ch: list_reduce(range(1, length({b}) + 1), lambda acc, j:
        list_append(acc, CASE WHEN substring({b}, j::INT, 1) = ch THEN rw[j] + 1 ELSE greatest(rw[j + 1], acc[j]) END),
        [0]::BIGINT[]), list_transform(range(0, length({b}) + 1), lambda z: 0::BIGINT))[-1]"""


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE 200.0 * {lcs(a, b)} / (length({a}) + length({b})) END)"


def key(col: str, n: int) -> str:
    return f"left({letters(col)}, {n})"


def words(col: str) -> str:
    return f"list_filter(string_split({col}, ' '), lambda w: length(w) > 1)"


#: table, its key, and the name of the phrase's column
PHRASES = r"""SELECT {1} AS id, phrase AS {2} FROM (SELECT {1}, unnest(string_split_regex(text, '[.,\n]+')) AS phrase FROM {0}) WHERE trim(phrase) <> ''"""


def match_sql(searches: str, score: str, cut_off: float, bound: str, titles: str = TITLES, match: str = "name", result: str = "page_id", suffixes=CLEANED_SUFFIXES) -> str:
    """Every search compared with every name that passes ``bound``, then the tiers."""
    return f"""
    WITH prepared AS (SELECT {normalized(match, suffixes)} AS name, {match} AS shown, {result} AS result FROM ({titles})),
    names AS MATERIALIZED (SELECT *, {fold('name')} AS nf, {key('name', 3)} AS n3, {key('name', 1)} AS n1, {words('name')} AS nw FROM (
        SELECT name, arg_max(shown, (result, shown)) AS shown, max(result) AS result FROM prepared WHERE name IS NOT NULL GROUP BY name)),
    wanted AS MATERIALIZED (SELECT DISTINCT {normalized('search', suffixes)} AS search FROM ({searches})),
    rest AS MATERIALIZED (SELECT search, greatest(3, least(10, CAST(ceil(length(search) / 3) AS INT))) AS tol,
                    {fold('search')} AS sf, {key('search', 3)} AS s3, {key('search', 1)} AS s1, {words('search')} AS sw FROM wanted
             WHERE search IS NOT NULL AND search NOT IN (SELECT name FROM names)),
    pairs AS (SELECT search, name, sf, nf, tol, abs(length(search) - length(name)) <= tol AS near,
                     s3 <> '' AND s3 = n3 AS b1, list_has_any(sw, nw) AS b2, s1 <> '' AND s1 = n1 AS b3, true AS b4
              FROM rest, names),
    passed AS MATERIALIZED (SELECT * FROM pairs WHERE {bound}),
    scored AS MATERIALIZED (SELECT * FROM (SELECT *, {score} AS score FROM passed) WHERE score >= {cut_off} AND score > 0),
    held AS (SELECT search, bool_or(b1 AND near) AS h1, bool_or(b2 AND near) AS h2, bool_or(b3 AND near) AS h3, bool_or(near) AS h4
             FROM pairs WHERE search IN (SELECT search FROM scored) GROUP BY search),
    tiered AS (SELECT s.search, s.name, score, CASE WHEN b1 AND (near OR NOT h1) THEN 1 WHEN b2 AND (near OR NOT h2) THEN 2
                      WHEN b3 AND (near OR NOT h3) THEN 3 WHEN near OR NOT h4 THEN 4 ELSE 5 END AS tier
               FROM scored s JOIN held h ON s.search = h.search),
    hits AS (SELECT search, name, score FROM tiered QUALIFY rank() OVER (PARTITION BY search ORDER BY tier, score DESC) = 1
             UNION ALL SELECT search, search, 100.0 FROM wanted WHERE search IN (SELECT name FROM names))
    SELECT w.search AS "Search_string", h.name AS "BestMatch", round(coalesce(h.score, 0.0), 6) AS "Score", n.shown AS {match}, n.result AS {result}
    FROM wanted w LEFT JOIN hits h ON w.search = h.search LEFT JOIN names n ON h.name = n.name WHERE w.search IS NOT NULL"""


def weighted_score() -> str:
    """The combined score from 90.01 on, which parts of names cannot reach: they count 0.9 at most."""
    tokens = f"0.95 * greatest({ratio(sorted_words('search'), sorted_words('name'))}, {token_set_score()})"
    alike = "greatest(length(search), length(name)) < 1.5 * least(length(search), length(name))"
    return f"greatest({ratio('search', 'name')}, CASE WHEN {alike} THEN {tokens} ELSE 0.0 END)"


def short_titles(n: int, column: str) -> str:
    return f"SELECT DISTINCT array_to_string(string_split(lower(name), ' ')[1:{n}], ' ') AS {column} FROM ({TITLES})"


def pairs_sql(score: str, cut_off: float) -> str:
    return f"""SELECT search, name, round(score, 6) AS score FROM (SELECT search, name, {score} AS score
        FROM ({short_titles(2, 'search')}), ({short_titles(3, 'name')}) WHERE search <> '' AND name <> '') WHERE score >= {cut_off}"""


def partial_pairs_sql(cut_off: float) -> str:
    """The best ratio of the shorter text with a window of its length, which may stand out at both ends of the longer."""
    cut = "substring(long, greatest(1, e - length(short) + 1)::INT, (least(e, length(long)) - greatest(1, e - length(short) + 1) + 1)::INT)"
    return f"""WITH s AS ({short_titles(2, 'search')}), n AS ({short_titles(3, 'name')}),
        p AS (SELECT search, name, search AS short, name AS long FROM s, n WHERE length(search) <= length(name)
              UNION ALL SELECT search, name, name, search FROM s, n WHERE length(name) <= length(search)),
        e AS (SELECT *, unnest(range(1, length(short) + length(long))) AS e FROM p WHERE short <> ''),
        w AS (SELECT search, name, short, {cut} AS w FROM e),
        d AS (SELECT DISTINCT short, w FROM w WHERE {near_enough('short', 'w', cut_off)}),
        r AS (SELECT short, w, {ratio('short', 'w')} AS score FROM d)
        SELECT search, name, round(max(score), 6) AS score FROM w JOIN r USING (short, w) GROUP BY search, name HAVING max(score) >= {cut_off}"""


def fold(col: str) -> str:
    """One byte for each character; what is not ASCII becomes equal, so no distance grows."""
    return f"regexp_replace({col}, '[^\\x00-\\x7F]', '~', 'g')"


def near_enough(a: str, b: str, cut_off: float) -> str:
    """Edits with replacements are never more than edits without; DuckDB counts them in bytes."""
    folded = {"search": "sf", "name": "nf"}  # as match_sql has them
    x, y = (folded.get(c) or fold(c) for c in (a, b))
    return f"levenshtein({x}, {y}) <= (length({a}) + length({b})) * {1 - cut_off / 100} + 1e-9"


def sorted_words(col: str) -> str:
    return f"array_to_string(list_sort(string_split({col}, ' ')), ' ')"


def token_set_score(bound: bool = False) -> str:
    """Score of the shared and the remaining words, as sorted texts; as a bound, what the edits of the rests allow."""
    both = "list_sort(list_intersect(string_split(search, ' '), string_split(name, ' ')))"

    def rest(a: str, b: str) -> str:
        return (f"array_to_string(list_sort(list_distinct(list_filter(string_split({a}, ' '), "
                f"lambda w: NOT list_contains(string_split({b}, ' '), w)))), ' ')")

    # what is not edited away is shared, and edits with replacements are never more than those without
    most = f"(length(a) + length(b) - levenshtein({fold('a')}, {fold('b')})) / 2" if bound else lcs("a", "b")
    alone = f"CASE WHEN {near_enough('a', 'b', 80)} THEN 100.0 ELSE 79.0 END" if bound else ratio("a", "b")
    share = f"(SELECT CASE WHEN i <> '' AND (a = '' OR b = '') THEN 100.0 WHEN i = '' THEN {alone} ELSE greatest("
    share += f"200.0 * (length(i) + 1 + {most}) / (2 * length(i) + 2 + length(a) + length(b)), "
    share += "200.0 * length(i) / (2 * length(i) + 1 + length(a)), 200.0 * length(i) / (2 * length(i) + 1 + length(b))) END "
    share += f"FROM (SELECT array_to_string({both}, ' ') AS i, {rest('search', 'name')} AS a, {rest('name', 'search')} AS b))"
    return share


def plain_sql(removed, suffixes, every: bool) -> str:
    def low(col: str, parts, ends) -> str:
        out = f"lower({col})"
        for part in parts:
            out = f"replace({out}, {lit(part)}, '')"
        for s in ends:
            out = f"CASE WHEN ends_with(lower({col}), {lit(s)}) THEN trim(lower({col})[1:length({col}) - {len(s)}]) ELSE {out} END"
        return out

    final = "rank() OVER (PARTITION BY search ORDER BY score DESC) = 1" if every else (
        "row_number() OVER (PARTITION BY search ORDER BY score DESC, page_id, shown) = 1")
    exact = "" if every else "QUALIFY row_number() OVER (PARTITION BY w.search ORDER BY page_id DESC, shown DESC) = 1"
    return f"""
    WITH names AS (SELECT {low('name', removed, suffixes)} AS name, name AS shown, page_id FROM ({TITLES})),
    wanted AS (SELECT DISTINCT {low('search', [], suffixes)} AS search FROM ({MISSPELLED})),
    distinct_names AS (SELECT DISTINCT name FROM names),
    near AS MATERIALIZED (SELECT search, name FROM wanted, distinct_names
               WHERE search NOT IN (SELECT name FROM names) AND {near_enough('(search)', '(name)', 80)}),
    scored AS MATERIALIZED (SELECT search, name, {ratio('search', 'name')} AS score FROM near),
    fuzzy AS (SELECT s.search, s.name, score, shown, page_id FROM scored s JOIN names n ON s.name = n.name WHERE score >= 80 QUALIFY {final}),
    exact AS (SELECT w.search, n.name, 100.0 AS score, shown, page_id FROM wanted w JOIN names n ON w.search = n.name {exact}),
    hits AS (SELECT * FROM fuzzy UNION ALL SELECT * FROM exact)
    SELECT DISTINCT w.search AS "Search_string", h.name AS "BestMatch", round(coalesce(h.score, 0.0), 6) AS "Score", h.shown AS name, h.page_id
    FROM wanted w LEFT JOIN hits h ON w.search = h.search"""


def dictionary_words() -> str:
    return " UNION ALL ".join(
        f"SELECT *, {lit(w)} AS search_word FROM ({DICTIONARY}) WHERE {any_has(w)}" for w in SEARCH_WORDS)


KEYED = f"SELECT *, {letters('\"Column\"')} AS letters_only FROM ({DICTIONARY})"
HEADED = f"SELECT heading, {letters('heading')} AS letters_only FROM ({HEADINGS})"
MAPPED = f"SELECT k.*, heading FROM ({KEYED}) k JOIN ({HEADED}) h ON k.letters_only = h.letters_only"

ORACLES: dict[str, str] = {
    "flagship": financials_where(
        f"(starts_with(entity_id, 'DK') OR starts_with(entity_id, 'SE') OR entity_id IN {in_list(SHORT_IDS)}) AND {YEARS}"),
    "extract_exact": financials_where(f"entity_id IN {in_list(SHORT_IDS)}"),
    "extract_prefix": financials_where(
        "starts_with(entity_id, 'DK') OR starts_with(entity_id, 'SE0') OR starts_with(entity_id, 'NO00')"),
    "extract_multi_column": f"SELECT * FROM ({TRADES}) WHERE buyer_id IN {in_list(SHORT_IDS)} OR seller_id IN {in_list(SHORT_IDS)}",
    "extract_layered": f"""SELECT * FROM ({TRADES}) WHERE
        ((buyer_id[1:2] IN ('DK', 'US') OR seller_id[1:2] IN ('DK', 'US')) AND seller_id[1:2] IN ('SE', 'US')
         AND buyer_id IN {in_list(SHORT_IDS + LONG_IDS)})
        OR buyer_id IN ('GB00000001', 'FR00000007') OR seller_id IN ('GB00000001', 'FR00000007')""",
    "extract_long_list": financials_where(f"entity_id IN {in_list(LONG_IDS)}"),
    "extract_semi_join": financials_where(f"entity_id IN (SELECT entity_id FROM ({ENTITIES}) WHERE c_acctbal > 5000)"),
    "year_range_native": financials_where(YEARS),
    "year_range_remove": text_years(False),
    "year_range_keep": text_years(True),
    "string_predicate": financials_where("total_assets > 400000"),
    "column_predicate": financials_where("o_orderstatus = 'F' AND total_assets BETWEEN 1000 AND 200000"),
    "table_function": f"SELECT entity_id, max(total_assets) AS largest, count(*) AS n FROM ({FINANCIALS}) GROUP BY entity_id",
    "partition_function": f"SELECT o_orderkey, total_assets / 1000 AS thousands FROM ({FINANCIALS}) WHERE total_assets > 250000",
    "part_function": "SELECT o_orderstatus, max(o_totalprice) AS largest, count(*) AS n FROM orders GROUP BY o_orderstatus",
    "extract_null_ids": f"""SELECT * FROM (SELECT *, CASE WHEN l_linenumber = 7 THEN seller_id END AS agent_id FROM ({TRADES}))
        WHERE agent_id IN {in_list(LONG_IDS)} OR buyer_id IN {in_list(LONG_IDS)}""",
    "extract_two_lists": f"""SELECT * FROM ({TRADES}) WHERE buyer_id IN {in_list(LONG_IDS)}
        AND buyer_id IN (SELECT entity_id FROM ({ENTITIES}) WHERE c_acctbal > 0)""",
    "extract_long_multi": f"""SELECT * FROM ({TRADES}) WHERE
        ((buyer_id IN (SELECT entity_id FROM ({ENTITIES}) WHERE c_acctbal > 5000) OR seller_id IN (SELECT entity_id FROM ({ENTITIES}) WHERE c_acctbal > 5000))
         AND (starts_with(seller_id, 'DK') OR starts_with(seller_id, 'SE') OR starts_with(seller_id, 'US')))
        OR seller_id IN (SELECT {entity('s_nationkey', 's_suppkey')} FROM supplier WHERE s_acctbal < -500)
        OR buyer_id IN (SELECT {entity('s_nationkey', 's_suppkey')} FROM supplier WHERE s_acctbal < -500) OR buyer_id IN {in_list(SHORT_IDS)}""",
    "id_list_file": f"""SELECT DISTINCT entity_id AS value, 'headed' AS form FROM ({ENTITIES})
        UNION ALL SELECT entity_id, 'plain' FROM ({ENTITIES})""",
    "id_list_kept": financials_where(f"entity_id IN (SELECT entity_id FROM ({ENTITIES}) WHERE c_acctbal < 0)"),
    "sample_limit": financials_where("true") + " ORDER BY o_orderkey LIMIT 1000",
    "national_id_lookup": f"SELECT entity_id, c_custkey FROM ({ENTITIES}) WHERE c_custkey IN (1, 7, 42, 99, 100, 1001)",
    "id_list_classify": f"""
        WITH v AS (SELECT entity_id AS value FROM ({ENTITIES}) UNION SELECT "Code" FROM ({COUNTRY_CODES}) UNION SELECT p_brand FROM part),
        m AS (SELECT value, value IN (SELECT "Code" FROM ({COUNTRY_CODES})) AS is_code,
                     regexp_matches(value, '^[A-Za-z]+[*]?[A-Za-z]*\\d*[-\\dA-Za-z]*$') AS is_id FROM v),
        t AS (SELECT CASE WHEN count(*) FILTER (WHERE is_code) >= count(*) FILTER (WHERE is_id) THEN 'prefix' ELSE 'exact' END AS mode FROM m)
        SELECT value, is_code, is_id, mode, CASE WHEN mode = 'prefix' THEN is_code ELSE is_id END AS kept FROM m, t""",
    "preflight_report": f"""SELECT true AS ok, 'total_assets,entity_id,closing_date' AS required_columns, 'closing_date' AS resolved_date_column,
        'entity_id' AS resolved_id_columns, false AS would_write, count(*) AS rows_out
        FROM ({FINANCIALS}) WHERE starts_with(entity_id, 'DK') AND {YEARS}""",
    "preflight_files": f"""SELECT CAST(year(closing_date) AS INTEGER) AS year, count(*) AS rows,
        year(closing_date) BETWEEN 1996 AND 1997 AND (min(entity_id)[:2] <= 'DK' AND 'DK' <= max(entity_id) OR min(entity_id)[:2] <= 'SE' AND 'SE' <= max(entity_id)) AS may_match
        FROM ({FINANCIALS}) GROUP BY year(closing_date)""",
    "year_distribution_orders": distribution(FINANCIALS, "closing_date"),
    "year_distribution_text": distribution(TEXT_DATES, "try_cast(closing_date AS TIMESTAMP)"),
    "mixed_format_union": "SELECT * FROM orders",
    "write_split_roundtrip": " UNION ALL ".join([f"SELECT * FROM ({FINANCIALS})"] * 3),
    "write_per_source": """SELECT 'orders' AS source_file, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
        UNION ALL SELECT 'lineitem', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM lineitem""",
    "null_column_fill": f"SELECT o_orderkey, total_assets, 'N/A' AS note FROM ({FINANCIALS})",
    "ingest_new_files": "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999",
    "batch_extract": f"""
        SELECT 1 AS n, 'financials' AS "table", 'written' AS status, count(*) AS rows FROM ({FINANCIALS}) WHERE entity_id IN {in_list(SHORT_IDS)}
        UNION ALL SELECT 2, 'missing', 'table not found', 0
        UNION ALL SELECT 3, 'trades', 'written', count(*) FROM ({TRADES}) WHERE buyer_id IN {in_list(SHORT_IDS)} OR seller_id IN {in_list(SHORT_IDS)}
        UNION ALL SELECT 4, 'trades', 'columns not found', 0""",
    "catalog_build": CATALOG,
    "catalog_newest": NEWEST,
    "catalog_newest_control": f"""WITH named AS (SELECT "Data Product" AS product, CASE WHEN "Data Product" < 'C' THEN min("Timestamp") ELSE max("Timestamp") END AS stamp
            FROM ({CATALOG}) GROUP BY "Data Product")
        SELECT "Data Product", "Table", "Top-level Directory" FROM ({CATALOG}) JOIN named ON "Data Product" = product AND "Timestamp" = stamp""",
    "catalog_stale": f"""SELECT DISTINCT "Data Product", "Export" FROM ({CATALOG}) WHERE "Export" NOT IN (SELECT "Export" FROM ({NEWEST}))""",
    "catalog_search": f"""SELECT * FROM ({CATALOG}) WHERE {any_has('buil', ('Data Product', 'Table'))}""",
    "catalog_resolve": f"""WITH m AS (SELECT DISTINCT "Data Product" AS name FROM ({CATALOG}) WHERE {has('"Data Product"', 'MA')})
        SELECT name, CASE WHEN (SELECT count(*) FROM m) = 1 THEN 'partial' ELSE 'ambiguous' END AS status FROM m
        UNION ALL SELECT NULL, 'none' WHERE NOT EXISTS (SELECT 1 FROM m)""",
    "product_match": """
        WITH have AS (SELECT DISTINCT 'supplier ' || l_suppkey AS export, p_name AS tab FROM lineitem JOIN part ON l_partkey = p_partkey),
        want AS (SELECT DISTINCT p_brand AS product, p_name AS tab FROM part),
        size AS (SELECT product, count(*) AS n FROM want GROUP BY product),
        done AS (SELECT export, h.product FROM (SELECT export, product, count(*) AS n FROM have JOIN want USING (tab) GROUP BY ALL) h
                 JOIN size s ON h.product = s.product AND h.n = s.n),
        options AS (SELECT export, 'Multiple_Options: ' || string_agg(product, ', ' ORDER BY product) AS label FROM done GROUP BY export)
        SELECT DISTINCT h.export, coalesce(label, 'Unknown') AS label FROM have h LEFT JOIN options o ON h.export = o.export""",
    "label_override": f"""
        WITH urgent AS (SELECT DISTINCT c_mktsegment || '_exported ' || strftime(o_orderdate, '%Y-%m-%d_%H-%M-%S') AS dir
                        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT')
        SELECT CASE WHEN "Top-level Directory" IN (SELECT dir FROM urgent) THEN 'Urgent ' || "Data Product" ELSE "Data Product" END AS "Data Product",
               "Table", "Base Directory", "Timestamp", "Export", "Top-level Directory" FROM ({CATALOG})""",
    "missing_files": "SELECT DISTINCT url AS path FROM pages WHERE NOT contains(url, '//www.')",
    "dictionary_search": f"SELECT * FROM ({DICTIONARY}) WHERE {any_has('RED')}",
    "dictionary_narrowed": f"""SELECT * FROM ({DICTIONARY}) WHERE "Data Product" = 'Brand#7' AND {has('"Table"', 'econ')}
        AND {any_has('size 1', ('Column', 'Definition'))}""",
    "dictionary_letters_only": f"""SELECT * FROM ({DICTIONARY}) WHERE contains({letters('"Data Product"')}, 'redbolt') OR contains({letters('"Table"')}, 'redbolt')
        OR contains({letters('"Column"')}, 'redbolt') OR contains({letters('"Definition"')}, 'redbolt')""",
    "dictionary_exact": f"""SELECT * FROM ({DICTIONARY}) WHERE "Column" = 'red bolt'""",
    "dictionary_multi_word": dictionary_words(),
    "dictionary_many_words": f"""SELECT t.*, w AS search_word FROM ({DICTIONARY}) t JOIN (SELECT DISTINCT p_name AS w FROM part)
        ON contains(lower("Data Product"), lower(w)) OR contains(lower("Table"), lower(w)) OR contains(lower("Column"), lower(w))
           OR contains(lower("Definition"), lower(w))""",
    "dictionary_many_exact": f"""SELECT t.*, w AS search_word FROM ({DICTIONARY}) t JOIN (SELECT p_type AS w FROM part UNION SELECT p_brand FROM part)
        ON w IN ("Data Product", "Table", "Column", "Definition")""",
    "dictionary_available": f"""SELECT * FROM ({DICTIONARY}) WHERE {any_has('red')}
        AND "Data Product" IN (SELECT p_brand FROM part WHERE p_size > 48)""",
    "metadata_read": f'SELECT DISTINCT "Data Product", "Column" FROM ({DICTIONARY})',
    "text_helpers": r"""SELECT p_partkey, p_name || '|' || p_brand || '|' || p_type AS listed,
        regexp_replace(p_name || '/' || p_brand, '[^\p{L}\p{N}._\- ]', '_', 'g') AS file FROM part""",
    "table_dates": f"""SELECT DISTINCT "Data Product", "Table", "Column" FROM ({DICTIONARY}) WHERE "Data Product" = 'Brand#3' AND {has('"Table"', 'small')}""",
    "country_search": f"""SELECT * FROM ({COUNTRY_CODES}) WHERE {has('"Code"', 'd')}""",
    "heading_map": f"""SELECT m.*, unique_headings FROM ({MAPPED}) m JOIN
        (SELECT "Data Product", count(DISTINCT heading) AS unique_headings FROM ({MAPPED}) GROUP BY 1) c ON m."Data Product" = c."Data Product\"""",
    "heading_unmatched": f"SELECT heading FROM ({HEADED}) WHERE letters_only NOT IN (SELECT letters_only FROM ({KEYED}))",
    "lineage_ids": f"WITH RECURSIVE {SUCCESSOR} SELECT id FROM found",
    "lineage_newest": f"WITH RECURSIVE {SUCCESSOR} SELECT id, newest_id FROM newest",
    "lineage_rows": f"""WITH RECURSIVE {SUCCESSOR} SELECT c.*, coalesce(a.newest_id, b.newest_id) AS newest_id FROM ({CHANGES}) c
        LEFT JOIN newest a ON c.old_id = a.id LEFT JOIN newest b ON c.new_id = b.id WHERE a.id IS NOT NULL OR b.id IS NOT NULL""",
    "profile_orders": profile_sql("SELECT * FROM orders", ORDER_COLUMNS, "Sales", "orders"),
    "profile_customer": profile_sql(ENTITIES, CUSTOMER_COLUMNS, "Sales", "customer"),
    "profile_date_formats": profile_sql(DATE_TEXTS, typed(**{n: TEXT for n in FORMS})),
    "profile_entity_ids": f"SELECT * FROM ({profile_sql(TRADES, TRADE_COLUMNS)}) WHERE mostly_entity_id_like",
    "profile_views": f"SELECT {OPERATION_LIST} FROM ({profile_sql(TEXT_DATES, TEXT_DATE_COLUMNS, 'Finance', 'financials')})",
    "profile_summary": f"""SELECT 'Finance' AS data_product, 'financials' AS "table", CAST(NULL AS VARCHAR) AS file_name,
        'all' AS sample_strategy, count(*) AS sampled_rows, 6 AS column_count FROM ({TEXT_DATES})""",
    "name_normalize": f"SELECT doc_id, {normalized('text')} AS name, {letters('text')} AS letters FROM documents",
    "name_blocks": f"""
        WITH n AS (SELECT {normalized('name')} AS name, page_id FROM ({TITLES})),
        u AS (SELECT name, max(page_id) AS page_id FROM n WHERE name IS NOT NULL GROUP BY name)
        SELECT name, page_id, {key('name', 3)} AS prefix3, {key('name', 1)} AS prefix1, length(name) AS name_len,
               array_to_string({words('name')}, ' ') AS tokens FROM u""",
    "name_exact": match_sql(f"SELECT translate(name, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS search FROM ({TITLES})", ratio("search", "name"), 100, near_enough("search", "name", 100)),
    "name_match_ratio": match_sql(MISSPELLED, ratio("search", "name"), 90, near_enough("search", "name", 90)),
    "name_match_ratio_low": match_sql(MISSPELLED, ratio("search", "name"), 60, near_enough("search", "name", 60)),
    "name_token_sort": match_sql(REORDERED, ratio(sorted_words("search"), sorted_words("name")), 85,
                                 near_enough(sorted_words("search"), sorted_words("name"), 85)),
    "name_token_set": match_sql(REORDERED, token_set_score(), 85, f"{token_set_score(bound=True)} >= 84"),
    "name_plain": plain_sql([], ["ltd", "inc"], False),
    "name_plain_ties": plain_sql([" ltd", " inc"], [], True),
    "name_best_ties": """SELECT DISTINCT p_brand AS "Search_string", p_name AS "BestMatch", CAST(p_size AS DOUBLE) AS "Score" FROM part
        QUALIFY rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) = 1""",
}
ORACLES |= {"saved_matches": ORACLES["name_best_ties"], "profile_report": ORACLES["profile_summary"], "profile_files": ORACLES["profile_orders"]}
ORACLES |= {"name_match_staged": ORACLES["name_match_ratio"]}
ORACLES |= {"profile_merged": ORACLES["profile_orders"]}
ORACLES |= {
    "name_match_wratio": match_sql(MISSPELLED, weighted_score(), 90.1, f"""{near_enough('search', 'name', 90)}
        OR {near_enough(sorted_words('search'), sorted_words('name'), 94)} OR {token_set_score(bound=True)} >= 94"""),
    "name_callable": match_sql(MISSPELLED, "100.0 - abs(length(search) - length(name))", 90,
                               f"{near_enough('search', 'name', 80)} AND {ratio('search', 'name')} >= 80"),
    "pairs_quick_ratio": pairs_sql(ratio("search", "name"), 75),
    "pairs_token_ratio": pairs_sql(f"greatest({ratio(sorted_words('search'), sorted_words('name'))}, {token_set_score()})", 70),
    "pairs_partial_ratio": partial_pairs_sql(80),
    "name_match_phrases": match_sql(PHRASES.format("benchmark", "item_id", "search"), ratio("search", "name"), 85, near_enough("search", "name", 85),
                                    PHRASES.format("documents", "doc_id", "phrase"), "phrase", "id", []),
    "table_files": f"""SELECT '/exports/' || export || '/' || replace(tab, 'interim_usd', 'usd_interim') || '.csv' AS path FROM ({ENTRIES})
        QUALIFY count(*) OVER (PARTITION BY export) = 1 OR tab = 'interim_usd_F'""",
    "table_schema": " UNION ALL ".join(f"SELECT '{t}' AS \"table\", column_name AS \"column\" FROM (DESCRIBE SELECT * FROM {t})" for t in ("orders", "customer", "documents")),
    "profile_first_file": f"""SELECT * REPLACE ('F.parquet' AS file_name, 'first_file' AS sample_strategy) FROM
        ({profile_sql("SELECT * FROM orders WHERE o_orderstatus = 'F'", ORDER_COLUMNS, "Sales", "orders")})""",
    "default_output": f"SELECT *, '2402030405_financials' AS name FROM ({FINANCIALS})",
    "id_column": f"""SELECT * FROM ({DICTIONARY}) WHERE "Column" = (SELECT max(p_name) FROM part)""",
    "period_validation": """WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
        a AS (SELECT y AS first FROM y UNION ALL SELECT 1899 UNION ALL SELECT NULL), b AS (SELECT y AS last FROM y UNION ALL SELECT 2999 UNION ALL SELECT NULL)
        SELECT first, last, coalesce(first >= 1900, true) AND coalesce(last <= 2024, true) AND coalesce(first <= last, true) AS valid FROM a, b""",
}
