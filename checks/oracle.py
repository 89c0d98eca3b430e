"""SQL for DuckDB that computes what each registered query must return, written independently of
the Spark expressions: plain columns for documents that were built from them, ``EXISTS`` for
anti-joins, and the scrubbing chain in RE2."""

from __future__ import annotations

from checks.fixtures import RUN_DATE, feed_sql

ORACLE: dict[str, str] = {}


def f(name: str) -> str:
    return f"({feed_sql(name)})"


# What Python's str.strip() removes, as DuckDB text.
_SPACE = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)"


def strip(expr: str) -> str:
    return f"trim({expr}, {_SPACE})"


_counter = [0]


def scrubbed(source: str, column: str, suffix: str, strip_quotes: bool = False) -> str:
    """A subquery with ``column`` scrubbed and the suffix it held in ``suffix``."""
    quotes = f"replace(regexp_replace({column}, ' \".*\"', '', 'g'), '\"', '')" if strip_quotes \
        else f"regexp_replace({column}, ' \".*\"', '', 'g')"
    one = (f"SELECT * REPLACE (CASE WHEN len(regexp_extract_all({column}, ' [A-Z]\\.')) = 1 "
           f"THEN regexp_replace({column}, ' [A-Z]\\.', '') ELSE {column} END AS {column}) FROM ({source})")
    two = f"SELECT * REPLACE ({quotes} AS {column}) FROM ({one})"
    three = (f"SELECT *, nullif({strip(f'''regexp_extract({column}, ' (Sr.|Jr.|III|IV)')''')}, '') AS {suffix} "
             f"FROM ({two})")
    bare = (f"replace(regexp_replace(regexp_replace({column}, ' (Sr.|Jr.|III|IV)', '', 'g'), ' \\(.*\\)', '', 'g'), "
            f"',', '')")
    return f"SELECT * REPLACE ({strip(bare)} AS {column}) FROM ({three})"


def nicknamed(source: str) -> str:
    """first_name resolved, nickname added."""
    return (f"SELECT s.* REPLACE (CASE WHEN k.n = 1 THEN k.full_name ELSE s.first_name END AS first_name), "
            f"CASE WHEN k.n = 1 THEN s.first_name END AS nickname FROM ({source}) s LEFT JOIN "
            f"(SELECT nickname AS nk, count(*) AS n, min(full_name) AS full_name FROM {f('nicknames')} GROUP BY 1) k "
            f"ON s.first_name = k.nk")


def none(*columns: str) -> str:
    return ", ".join(f"nullif({c}, 'None') AS {c}" for c in columns)


# ---- names and text --------------------------------------------------------------------------

_first = scrubbed(f("members"), "first_name", "suffix")
_both = scrubbed(scrubbed(f("members"), "first_name", "s1"), "last_name", "s2")

ORACLE["scrub_first"] = f"SELECT member_id, first_name, suffix FROM ({_first})"
ORACLE["scrub_last_suffix"] = f"SELECT member_id, last_name, coalesce(s1, s2) AS suffix FROM ({_both})"
ORACLE["scrub_texts"] = scrubbed("SELECT doc_id, text AS last_name FROM documents", "last_name", "suffix")
ORACLE["scrub_strip_quotes"] = "SELECT member_id, first_name, suffix FROM (" + scrubbed(
    f"SELECT * REPLACE (first_name || '\" x' AS first_name) FROM {f('members')}", "first_name", "suffix", True) + ")"


def _legacy(c: str) -> str:
    def bare(quoted: str) -> str:
        return (f"replace(regexp_replace(regexp_replace({c}, '{quoted}', '', 'g'), ' (Sr.|Jr.|III|IV)', '', 'g'), "
                f"',', '')")
    return (f"{strip('''CASE WHEN len(regexp_extract_all(%s, '[A-Z]\\.')) = 1 THEN regexp_replace(%s, ' [A-Z]\\.', '', 'g') ELSE %s END''' % (c, bare(' \".*\"'), bare('\".*\"')))}")


ORACLE["scrub_legacy"] = (f"SELECT member_id, {_legacy('first_name')} AS first_name, "
                          f"{_legacy('last_name')} AS last_name FROM {f('members')}")
ORACLE["find_suffix"] = (
    "SELECT member_id, coalesce(nullif(regexp_extract(first_name, '(Sr.|Jr.|III|IV)'), ''), "
    f"nullif(regexp_extract(last_name, '(Sr.|Jr.|III|IV)'), '')) AS suffix FROM {f('members')}")
ORACLE["clean_bill"] = (f"SELECT bill_key, upper(replace(replace(raw_title, ' ', ''), '.', '')) AS bill_id "
                        f"FROM {f('raw_bills')}")
ORACLE["congress_session"] = """
SELECT o_orderkey, CAST((year(o_orderdate) - 1789) // 2 + 1 AS INTEGER) AS congress,
  CAST(CASE WHEN year(o_orderdate) % 2 = 0 THEN 2 ELSE 1 END AS INTEGER) AS session FROM orders"""
ORACLE["transliterate"] = "SELECT doc_id, replace(strip_accents(text), 'ß', 'ss') AS text FROM documents"
ORACLE["comma_strip"] = """SELECT doc_id, replace(text, ',', '') AS text, replace(lang, ',', '') AS lang,
  replace(source, ',', '') AS source FROM documents"""
ORACLE["fullname_split"] = f"""
SELECT member_id, trim(CASE WHEN member_id % 2 = 0 THEN split_part(last_name || ', ' || first_name, ',', 2)
    WHEN first_name LIKE '%,%' THEN split_part(first_name, ',', 2) ELSE first_name END) AS first_name,
  trim(CASE WHEN member_id % 2 = 0 THEN split_part(last_name, ',', 1)
    WHEN first_name LIKE '%,%' THEN 'Member ' || split_part(first_name, ',', 1) ELSE 'Member' END) AS last_name
FROM {f('members')}"""
_POL = r"^[^ ]* ([^,]*),([^\[]*)\[([^-\]]*)-([^-\]]*)(-[^\]]*)?\]"
ORACLE["sponsor_parse"] = "SELECT bill_key, " + ", ".join(
    f"CASE WHEN raw_sponsor LIKE '%[%' THEN trim(regexp_extract(raw_sponsor, '{_POL}', {i})) END AS {n}"
    for i, n in ((2, "first_name"), (1, "last_name"), (3, "party"), (4, "state"))) + f" FROM {f('raw_bills')}"


def _bill(title: str) -> dict[str, str]:
    def bare(c: str) -> str:
        return f"replace(replace({c}, ' ', ''), '.', '')"
    dash, to = f"position('-' IN {title})", f"position('to' IN {title})"
    return {
        "bill_id": f"CASE WHEN {dash} > 0 THEN {bare(f'substr({title}, 1, {dash} - 1)')} "
                   f"WHEN {to} > 0 THEN {bare(f'substr({title}, {to} + 2)')} END",
        "amdt_id": f"CASE WHEN {dash} = 0 AND {to} > 0 THEN {bare(f'substr({title}, 1, {to} - 1)')} END",
        "bill_title": f"CASE WHEN {dash} > 0 THEN trim(substr({title}, {dash} + 1)) WHEN {to} > 0 THEN {title} END",
    }


ORACLE["bill_parse"] = "SELECT bill_key, " + ", ".join(
    f"{c} AS {n}" for n, c in _bill("raw_title").items()) + f" FROM {f('raw_bills')}"
ORACLE["char_positions"] = """
SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, ''),
  lambda x, i: CASE WHEN x = ',' THEN i - 1 END), lambda p: p IS NOT NULL), ',') AS positions FROM documents"""
ORACLE["url_strip"] = "SELECT page_id, split_part(url, '?', 1) AS url FROM pages"
_LINKS = """SELECT page_id, url, html, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link FROM pages"""
ORACLE["url_resolve"] = f"""
SELECT page_id, link AS href, regexp_extract(url, '^(https?://[^/]*)', 1) || link AS absolute,
  regexp_extract(url, '^(https?://[^/]*)', 1) ||
    CASE WHEN regexp_matches(url, '^https?://[^/]*/[^/?#]*/[^/?#]+/') THEN
      regexp_extract(url, '^https?://[^/]*(/[^/?#]*/)', 1) ELSE '/' END || 'x/' || substr(link, 2) AS upward
FROM ({_LINKS})"""

# ---- casts and recodes -----------------------------------------------------------------------

_INT = "regexp_matches(trim(vote_cast), '^[+-]?[0-9]+$')"
_BAD = "'invalid literal for int() with base 10: ''' || vote_cast || ''''"
ORACLE["fix_types"] = f"""
SELECT vote_id, CASE WHEN {_INT} THEN TRY_CAST(vote_cast AS INTEGER) END AS vote_cast,
  CASE WHEN NOT {_INT} THEN {_BAD} END AS error_msg, CASE WHEN NOT {_INT} THEN 'FixTypesFn' END AS ptransform
FROM {f('votes')}"""
ORACLE["fix_none"] = f"SELECT vote_id, {none('amdt_id', 'first_name', 'vote_cast')} FROM {f('votes')}"
_TEXT = """CASE WHEN l_returnflag = 'A' THEN 'Yea' WHEN l_returnflag = 'N' THEN 'No'
  WHEN l_linenumber = 1 THEN 'Nay' WHEN l_linenumber = 2 THEN 'Aye' ELSE 'Present' END"""
ORACLE["vote_recode_senate"] = f"""
SELECT l_orderkey, l_linenumber, CAST(CASE t WHEN 'Yea' THEN 1 WHEN 'Nay' THEN 0 END AS INTEGER) AS vote_cast
FROM (SELECT l_orderkey, l_linenumber, {_TEXT} AS t FROM lineitem)"""
ORACLE["vote_recode_house"] = f"""
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN t IN ('Yea', 'Aye') THEN 1 WHEN t IN ('Nay', 'No') THEN 0 END
  AS INTEGER) AS vote_cast FROM (SELECT l_orderkey, l_linenumber, {_TEXT} AS t FROM lineitem)"""
_DAY = "CAST(o_orderdate AS DATE)"
ORACLE["date_parse"] = f"""
SELECT o_orderkey, {_DAY} AS senate_vote, {_DAY} AS house_vote, {_DAY} AS senate_menu, {_DAY} AS house_index,
  CASE WHEN o_orderstatus <> 'P' THEN {_DAY} END AS introduced FROM orders"""
ORACLE["amendment_number"] = """
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS INTEGER) AS amdt_num,
  CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'no single amendment number' END AS error_msg,
  CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'house_votes' END AS ptransform FROM orders"""

# ---- filters and routing ---------------------------------------------------------------------

ORACLE["tag_errors_counts"] = f"""
SELECT CASE WHEN {_INT} THEN 'clean' ELSE 'error' END AS branch, count(*) AS n FROM {f('votes')} GROUP BY 1"""
ORACLE["route_by_keys"] = """
SELECT event_id, event_type <> 'error' AS is_bill, event_type <> 'click' AS is_cosponsor FROM events"""
ORACLE["route_cosponsors"] = """
SELECT CAST(value AS VARCHAR) AS bill_id,
  CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS amdt_id,
  CASE WHEN event_type = 'error' THEN props END AS cosponsor_fn,
  CAST(NULL AS VARCHAR) AS cosponsor_ln, CAST(NULL AS VARCHAR) AS cosponsor_party,
  CAST(NULL AS VARCHAR) AS cosponsor_state
FROM events WHERE event_type <> 'click'"""
ORACLE["recent_through"] = f"""
SELECT o_orderkey, {_DAY} AS bill_date FROM orders WHERE {_DAY} <= DATE '1998-05-31'"""
ORACLE["recent_only"] = f"""
SELECT o_orderkey, {_DAY} AS bill_date FROM orders WHERE {_DAY} = DATE '1998-05-31'"""
ORACLE["link_filter"] = """
SELECT page_id, list_filter(regexp_extract_all(html, '<a href="([^"]*)"', 1),
  lambda v: v LIKE '%.' OR v LIKE '%,')[1] AS link FROM pages"""
ORACLE["header_skip"] = """
SELECT page_id, CAST(i - 2 AS INTEGER) AS pos, regexp_extract(items[i], '>([^<>]*)</a>', 1) AS row_text FROM (
  SELECT page_id, items, unnest(range(2, len(items) + 1)) AS i FROM (
    SELECT page_id, regexp_extract_all(html, '<li>.*?</li>') AS items FROM pages))"""

# ---- lookups ---------------------------------------------------------------------------------

ORACLE["nickname_lookup"] = f"SELECT member_id, first_name, nickname FROM ({nicknamed(_first)})"
ORACLE["nickname_first"] = f"""
SELECT m.member_id, coalesce(k.full_name, m.first_name) AS first_name,
  CASE WHEN k.full_name IS NOT NULL THEN m.first_name END AS nickname
FROM ({_first}) m LEFT JOIN (SELECT nickname, min(full_name) AS full_name FROM {f('nicknames')} GROUP BY 1) k
  ON m.first_name = k.nickname"""
_MANY_POLS = "There are multiple politicians with that name active on that day."
_NO_POLS = "There are no politicians with that name active on that day."


def _house(source: str) -> str:
    """votes with ``matches`` and ``found`` from the house table, and ``missing``."""
    return f"""SELECT v.*, coalesce(h.n, 0) AS matches, h.found, v.first_name IN ('', 'None') AS missing
      FROM ({source}) v LEFT JOIN (SELECT last_name AS hl, party AS hp, state AS hs, date AS hd, count(*) AS n,
        min(first_name) AS found FROM {f('house')} GROUP BY ALL) h
      ON v.last_name = h.hl AND v.party = h.hp AND v.state = h.hs AND CAST(v.vote_date AS DATE) = h.hd"""


ORACLE["house_first_name"] = f"""
SELECT vote_id, CASE WHEN missing AND matches = 1 THEN found ELSE first_name END AS first_name, last_name, party,
  state, vote_date,
  CASE WHEN missing AND matches > 1 THEN '{_MANY_POLS}' WHEN missing AND matches = 0 THEN '{_NO_POLS}' END AS error_msg,
  CASE WHEN missing AND matches <> 1 THEN 'FixHouseFirstNameFn' END AS ptransform
FROM ({_house('SELECT vote_id, first_name, last_name, party, state, vote_date FROM ' + f('votes'))})"""
ORACLE["house_first_name_shuffled"] = ORACLE["house_first_name"]


def _mapped(source: str) -> str:
    return f"""SELECT s.*, coalesce(k.n, 0) AS states, k.initials FROM ({source}) s LEFT JOIN
      (SELECT state AS st, count(*) AS n, min(initials) AS initials FROM {f('states')} GROUP BY 1) k ON s.state = k.st"""


_STATE_MSG = """CASE WHEN states > 1 THEN 'There are multiple states in the database that match the given state.'
    WHEN states = 0 THEN 'There are no states in the database that match the given state.' END"""
ORACLE["state_map"] = f"""
SELECT member_id, CASE WHEN states = 1 THEN initials ELSE state END AS state, {_STATE_MSG} AS error_msg,
  CASE WHEN states <> 1 THEN 'StateMapFn' END AS ptransform FROM ({_mapped('SELECT * FROM ' + f('members'))})"""


def _unknown(source: str, columns: str) -> str:
    return f"""SELECT {columns} FROM ({source}) m WHERE NOT EXISTS (SELECT 1 FROM {f('politicians')} p
      WHERE p.first_name = m.first_name AND p.last_name = m.last_name AND p.party = m.party AND p.state = m.state)"""


ORACLE["new_politicians"] = _unknown(
    f"SELECT * REPLACE (replace(state, 'NATION_', 'S') AS state) FROM ({_both})",
    "member_id, first_name, last_name, party, state")
ORACLE["new_politicians_shuffled"] = ORACLE["new_politicians"]
ORACLE["new_politicians_by_bitmap"] = ORACLE["new_politicians"]
ORACLE["house_rows_before"] = f"SELECT * FROM {f('house')} WHERE date < DATE '1998-05-31'"
_BILL_URL = "'https://www.congress.gov/bill/115/hr/' || CAST(o_custkey AS VARCHAR) || '/amendments?pageSort=asc'"
ORACLE["bill_url_carry"] = f"""
SELECT o_orderkey AS doc_id, 'HR' || CAST(o_custkey AS VARCHAR) AS bill_id,
  CASE WHEN {_DAY} <= DATE '{RUN_DATE}' - 1 THEN {_BILL_URL} END AS bill_url FROM orders"""
_HOUSE_VOTE = """CAST(CASE (o_orderkey + i) % 5 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 0 END
  AS INTEGER)"""
_ORDER_ENTRIES = "SELECT *, unnest(range(1, 2 + o_orderkey % 3)) AS i FROM orders"


def _house_votes(amdt: str, message: str, step: str) -> str:
    return f"""
SELECT o_orderkey AS doc_id, 'HR' || CAST(o_custkey AS VARCHAR) AS bill_id, {amdt} AS amdt_id,
  CAST(NULL AS VARCHAR) AS first_name, 'Member' || CAST(o_custkey AS VARCHAR) AS last_name, 'R' AS party,
  'S' || CAST(i AS VARCHAR) AS state, {_HOUSE_VOTE} AS vote_cast, {_DAY} AS vote_date, 'HR' AS chamber,
  'US' AS chamber_state, {message} AS error_msg, {step} AS ptransform FROM ({_ORDER_ENTRIES})"""


_NULL = "CAST(NULL AS VARCHAR)"
ORACLE["house_votes_xml"] = _house_votes(_NULL, _NULL, _NULL)
_N = "(o_orderkey % 7)"
_UNLISTED = f"(o_orderkey % 4 <> 0 AND {_N} NOT BETWEEN 1 AND 6)"
ORACLE["house_votes_amended"] = _house_votes(
    f"CASE WHEN o_orderkey % 4 <> 0 AND NOT {_UNLISTED} THEN 'HAMDT' || CAST(o_custkey * 10 + {_N} AS VARCHAR) END",
    f"CASE WHEN {_UNLISTED} THEN 'amendment is not listed' END",
    f"CASE WHEN {_UNLISTED} THEN 'resolve_amendments' END")

# ---- projections -----------------------------------------------------------------------------

ORACLE["filter_keys"] = f"""
SELECT first_name, last_name, party, state, {_NULL} AS suffix, {_NULL} AS nickname FROM {f('members')}"""
_FN, _LN, _PA, _ST = "sponsor_fn", "sponsor_ln", "sponsor_party", "sponsor_state"
ORACLE["normalize_sponsors"] = f"""
SELECT bill_key, sponsor_fn AS first_name, CASE WHEN {_FN} IS NOT NULL THEN sponsor_ln END AS last_name,
  CASE WHEN {_FN} IS NOT NULL THEN sponsor_party END AS party,
  CASE WHEN {_FN} IS NOT NULL AND {_ST} IS NOT NULL THEN sponsor_state END AS state,
  CASE WHEN {_FN} IS NULL THEN sponsor_ln END AS sponsor_ln,
  CASE WHEN {_FN} IS NULL THEN sponsor_state END AS sponsor_state,
  CASE WHEN {_FN} IS NULL OR {_ST} IS NULL THEN 'NormalizeAttributesFn' END AS ptransform,
  CASE WHEN {_FN} IS NULL THEN 'missing value: sponsor_fn'
    WHEN {_ST} IS NULL THEN 'missing value: sponsor_state' END AS error_msg FROM {f('bills')}"""
ORACLE["revert_sponsors"] = f"""
SELECT bill_key, sponsor_fn, sponsor_ln, sponsor_party, sponsor_state,
  CASE WHEN {_FN} IS NULL OR {_ST} IS NULL THEN 'RevertAttributesFn' END AS ptransform FROM {f('bills')}"""
ORACLE["add_date"] = f"SELECT member_id, DATE '{RUN_DATE}' AS date FROM {f('members')}"
ORACLE["add_constants"] = f"SELECT member_id, 'SN' AS chamber, 'US' AS chamber_state FROM {f('members')}"
_BILL = ("bill_id", "amdt_id", "bill_title", "bill_summary", _FN, _LN, _PA, _ST, "bill_url")
ORACLE["make_strings"] = "SELECT " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), 'None') AS {c}" for c in ("bill_key", *_BILL) if c != "bill_title"
) + f" FROM {f('bills')}"
ORACLE["csv_row"] = "SELECT bill_key, " + " || ',' || ".join(
    f"coalesce({c}, '')" for c in _BILL) + f" || ',,,' AS line FROM {f('bills')}"
ORACLE["title_concat"] = f"""
SELECT bill_key, raw_title || CASE WHEN bill_key % 5 <> 0 THEN subtitle ELSE '' END AS bill_title
FROM {f('raw_bills')}"""

# ---- messages and tables ---------------------------------------------------------------------

_EMPTY = "amdt_id = 'SAMDT7'"
ORACLE["isolate_attrs"] = f"""
SELECT CASE WHEN NOT {_EMPTY} THEN CAST(vote_id AS VARCHAR) END AS vote_id,
  CASE WHEN NOT {_EMPTY} THEN bill_id END AS bill_id, CASE WHEN NOT {_EMPTY} THEN amdt_id END AS amdt_id,
  CASE WHEN NOT {_EMPTY} THEN vote_cast END AS vote_cast, {_NULL} AS absent,
  CASE WHEN {_EMPTY} THEN 'message has no attributes' END AS error_msg,
  CASE WHEN {_EMPTY} THEN 'IsolateAttrFn' END AS ptransform FROM {f('votes')}"""
ORACLE["build_message"] = f"""
SELECT 'A bill.' AS data, CAST(bill_key AS VARCHAR) AS bill_key, coalesce(sponsor_fn, 'None') AS sponsor_fn,
  coalesce(sponsor_state, 'None') AS sponsor_state, CAST(10 AS INTEGER) AS n_attributes FROM {f('bills')}"""
_COS = ("bill_id", "amdt_id", "cosponsor_fn", "cosponsor_ln", "cosponsor_party", "cosponsor_state")
ORACLE["format_attributes"] = (
    f"SELECT CAST(bill_key AS VARCHAR) AS topic_name, '{','.join(_COS)}' AS header, "
    + " || ',' || ".join(f"coalesce({c}, 'None')" for c in _COS) + f" AS line FROM {f('cosponsors')}")
ORACLE["dimension_text"] = f"SELECT * REPLACE (CAST(id AS VARCHAR) AS id) FROM {f('politicians')}"
ORACLE["name_listing"] = f"SELECT id, first_name, last_name FROM {f('politicians')} ORDER BY id"
ORACLE["document_scan"] = "SELECT page_id AS doc_id, url, html AS body FROM pages"
_SPLIT_BAD = "bill_key % 10 IN (3, 4)"
ORACLE["split_lines"] = "SELECT bill_key, " + ", ".join(
    f"CASE WHEN NOT {_SPLIT_BAD} THEN " + (f"coalesce({c}, '')" if c != "cosponsor_ln"
                                           else f"coalesce({c}, '') || ', x'") + f" END AS {c}" for c in _COS
) + f", CASE WHEN {_SPLIT_BAD} THEN 'SplitFn' END AS ptransform FROM {f('cosponsors')}"
ORACLE["landed_bills"] = "SELECT " + ", ".join(f"coalesce({c}, '') AS {c}" for c in _BILL) + (
    f", {_NULL} AS error_msg, {_NULL} AS ptransform FROM {f('bills')}")


ORACLE["landed_index"] = f"""
SELECT row_number() OVER (ORDER BY bill_id) - 1 AS idx, bill_id FROM {f('bills')}"""


def _resolved_members(source: str, strip_quotes: bool = False) -> str:
    first = scrubbed(source, "first_name", "s1", strip_quotes)
    last = scrubbed(nicknamed(first), "last_name", "s2", strip_quotes)
    return f"SELECT * EXCLUDE (s1, s2), coalesce(s1, s2) AS suffix FROM ({last})"


_PERSON = f"{none('first_name', 'last_name', 'party')}"


def _house_rows(source: str, day: str, strip_quotes: bool = False) -> str:
    return f"""SELECT {_PERSON}, initials AS state, district, DATE '{day}' AS date
      FROM ({_mapped(_resolved_members(source, strip_quotes))}) WHERE states = 1"""


ORACLE["landed_members"] = _house_rows(
    f"SELECT * REPLACE (replace(first_name, ',', '') AS first_name) FROM {f('members')}", RUN_DATE)
ORACLE["append_table"] = f"""
SELECT first_name, last_name, party, state, district, date FROM {f('house')}
UNION ALL SELECT first_name, last_name, party, state, district, CAST(NULL AS DATE) FROM {f('members')}"""

# ---- documents -------------------------------------------------------------------------------


def unescaped(c: str) -> str:
    return f"replace(replace({c}, '&quot;', '\"'), '&amp;', '&')"


ORACLE["page_title"] = f"SELECT page_id, {unescaped(r'''regexp_extract(html, '<h1>([^<]*)</h1>', 1)''')} AS title FROM pages"
ORACLE["page_links"] = """
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, links[i] AS link FROM (
  SELECT page_id, links, unnest(range(1, len(links) + 1)) AS i FROM (
    SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages))"""
ORACLE["page_text_nodes"] = """
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, nodes[i] AS node FROM (
  SELECT page_id, nodes, unnest(range(1, len(nodes) + 1)) AS i FROM (
    SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">([^<]+)</a>', 1) AS nodes FROM pages))"""
_BROKEN = "(o_orderstatus = 'P' AND o_custkey % 7 = 0)"
_ROSTER = "o_orderkey AS doc_id, 'https://www.senate.gov/' || CAST(o_orderkey AS VARCHAR) AS url"
ORACLE["senate_roster_xml"] = f"""
SELECT {_ROSTER}, 'Ann ' || CAST(i AS VARCHAR) AS first_name,
  'Member' || CAST(o_custkey AS VARCHAR) || '&' || CAST(i AS VARCHAR) AS last_name, 'D' AS party,
  'S' || CAST(o_custkey % 25 AS VARCHAR) AS state, {_NULL} AS error_msg, {_NULL} AS ptransform
FROM ({_ORDER_ENTRIES}) WHERE NOT {_BROKEN}
UNION ALL SELECT {_ROSTER}, NULL, NULL, NULL, NULL, 'document is not well-formed', 'senate_roster'
FROM orders WHERE {_BROKEN}"""
_AMENDS, _NO_BILL = "o_custkey % 3 = 0", "(o_custkey % 3 <> 0 AND o_custkey % 50 = 1)"
ORACLE["senate_votes_xml"] = f"""
SELECT o_orderkey AS doc_id,
  CASE WHEN {_AMENDS} THEN 'S' || CAST(o_orderkey AS VARCHAR) WHEN NOT {_NO_BILL} THEN 'HR' || CAST(o_orderkey AS VARCHAR)
    END AS bill_id,
  CASE WHEN {_AMENDS} THEN 'SAMDT' || CAST(o_custkey AS VARCHAR) END AS amdt_id,
  'Ann' || CAST(i AS VARCHAR) AS first_name, 'Member' || CAST(o_custkey AS VARCHAR) AS last_name, 'R' AS party,
  'S' || CAST(o_custkey % 25 AS VARCHAR) AS state,
  CAST(CASE (o_orderkey + i) % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS INTEGER) AS vote_cast,
  {_DAY} AS vote_date, 'SN' AS chamber, 'US' AS chamber_state,
  CASE WHEN {_NO_BILL} THEN 'no bill number' END AS error_msg,
  CASE WHEN {_NO_BILL} THEN 'senate_votes' END AS ptransform FROM ({_ORDER_ENTRIES})"""
_NO_TABLE = "c_custkey % 40 = 9"
_PARTY = "CASE c_custkey % 3 WHEN 0 THEN 'D' WHEN 1 THEN 'R' ELSE 'I' END"
ORACLE["house_roster_html"] = f"""
SELECT c_custkey AS doc_id, 'https://www.house.gov/representatives' AS url,
  CASE WHEN i = 2 THEN 'Al' ELSE 'Kim' END AS first_name,
  CASE WHEN i = 2 THEN 'Member' ELSE 'O''Member' END || CAST(c_custkey AS VARCHAR) AS last_name,
  {_PARTY} AS party, 'NATION_' || CAST(c_nationkey AS VARCHAR) AS state,
  CAST(i AS VARCHAR) || 'st' AS district, DATE '{RUN_DATE}' AS date, {_NULL} AS error_msg, {_NULL} AS ptransform
FROM (SELECT *, unnest(range(1, 2 + c_custkey % 3)) AS i FROM customer) WHERE NOT {_NO_TABLE}
UNION ALL SELECT c_custkey, 'https://www.house.gov/representatives', NULL, NULL, NULL, NULL, NULL,
  DATE '{RUN_DATE}', 'page has no table', 'house_roster' FROM customer WHERE {_NO_TABLE}"""
ORACLE["landed_roster"] = f"""
SELECT CASE WHEN i = 2 THEN 'Al' ELSE 'Kim' END AS first_name,
  CASE WHEN i = 2 THEN 'Member' ELSE 'O''Member' END || CAST(c_custkey AS VARCHAR) AS last_name,
  {_PARTY} AS party, 'NATION_' || CAST(c_nationkey AS VARCHAR) AS state,
  CAST(i AS VARCHAR) || 'st' AS district, '{RUN_DATE}' AS date, {_NULL} AS error_msg, {_NULL} AS ptransform
FROM (SELECT *, unnest(range(1, 2 + c_custkey % 3)) AS i FROM customer) WHERE NOT {_NO_TABLE}"""
ORACLE["house_roll_index_html"] = f"""
SELECT o_orderkey AS doc_id, 'http://clerk.house.gov/evs/1998/ROLL_' || CAST(o_orderkey AS VARCHAR) || '.asp' AS url,
  'http://clerk.house.gov/cgi-bin/vote.asp?year=1998&rollnumber=' || CAST(o_orderkey AS VARCHAR) AS vote_url,
  {_BILL_URL} AS bill_url, {_DAY} AS bill_date, {_NULL} AS error_msg, {_NULL} AS ptransform
FROM orders WHERE {_DAY} <= DATE '1998-05-31'"""
ORACLE["roll_index_links_html"] = f"""
WITH found AS (SELECT page_id AS doc_id, url,
  regexp_extract(url, '^(https?://[^?#]*/)', 1) || 'ROLL_' || substr(link, 3) AS link
FROM ({_LINKS}) WHERE link LIKE '/t%'
UNION ALL
SELECT page_id, url, regexp_extract(url, '^(https?://[^/]*)', 1) || link FROM ({_LINKS})
WHERE link LIKE '%ROLL%' AND link NOT LIKE '/t%')
SELECT *, CAST(NULL AS VARCHAR) AS error_msg, CAST(NULL AS VARCHAR) AS ptransform FROM found
UNION ALL SELECT page_id, url, NULL, 'document has no links to roll calls', 'roll_index_links' FROM pages
WHERE page_id NOT IN (SELECT doc_id FROM found)"""
ORACLE["senate_vote_menu_html"] = f"""
SELECT o_orderkey AS doc_id, 'https://www.senate.gov/legislative/LIS/roll_call_lists/roll_call_vote_cfm.cfm?congress=115&vote='
  || CAST(o_orderkey AS VARCHAR) AS vote_url, {_DAY} AS bill_date, {_NULL} AS error_msg, {_NULL} AS ptransform
FROM orders WHERE {_DAY} <= DATE '1998-05-31'"""
ORACLE["senate_xml_edition"] = """
SELECT page_id AS doc_id, url, regexp_extract(url, '^(https?://[^/]*)', 1) || '/xml/vote_' || CAST(page_id AS VARCHAR)
  || '.xml' AS xml_url, CAST(NULL AS VARCHAR) AS error_msg, CAST(NULL AS VARCHAR) AS ptransform FROM pages"""
_PART_URL = "'https://www.congress.gov/bill/115th-congress/house-bill/' || CAST({} AS VARCHAR)"
ORACLE["bill_search_html"] = f"""
SELECT p_partkey AS doc_id, {_PART_URL.format('p_partkey')} AS bill_url,
  CASE WHEN p_size % 2 = 0 THEN make_date(2018, CAST(p_size % 12 + 1 AS BIGINT), 3) END AS introduced,
  CAST(NULL AS VARCHAR) AS error_msg, CAST(NULL AS VARCHAR) AS ptransform FROM part"""
ORACLE["bill_search_next_page"] = """
SELECT p_partkey AS doc_id,
  CASE WHEN p_size % 3 = 0 THEN 'https://www.congress.gov/search?q=x&page=2' END AS next_url FROM part"""
_PAGE_BILL = _bill("raw_title")
_SPONSORED = "raw_sponsor LIKE '%[%'"


def _pol(i: int) -> str:
    return f"CASE WHEN {_SPONSORED} THEN trim(regexp_extract(raw_sponsor, '{_POL}', {i})) END"


ORACLE["bill_details_html"] = f"""
SELECT bill_key AS doc_id, {_PAGE_BILL['bill_id']} AS bill_id, {_PAGE_BILL['amdt_id']} AS amdt_id,
  {_PAGE_BILL['bill_title']} || subtitle || ' (Introduced 01/03/2018)' AS bill_title, 'About ' || subtitle || ' & more.' AS bill_summary,
  {_pol(2)} AS sponsor_fn, {_pol(1)} AS sponsor_ln, {_pol(3)} AS sponsor_party, {_pol(4)} AS sponsor_state,
  {_PART_URL.format('bill_key')} AS bill_url,
  {_PART_URL.format('bill_key')} || '/cosponsors?r=1&s=2' AS cosponsors_url,
  CASE WHEN NOT {_SPONSORED} THEN 'no sponsor' WHEN {_PAGE_BILL['bill_id']} IS NULL THEN 'no bill number' END AS error_msg,
  CASE WHEN NOT {_SPONSORED} OR {_PAGE_BILL['bill_id']} IS NULL THEN 'bill_details' END AS ptransform
FROM {f('raw_bills')}"""


def _cos(i: int, fixed: str) -> str:
    return f"CASE WHEN i < 3 THEN {fixed} ELSE {_pol(i)} END"


_UNREAD = f"(i = 3 AND NOT {_SPONSORED})"
_NO_NUMBER = f"{_PAGE_BILL['bill_id']} IS NULL"
ORACLE["cosponsors_html"] = f"""
SELECT bill_key AS doc_id, {_PAGE_BILL['bill_id']} AS bill_id, {_PAGE_BILL['amdt_id']} AS amdt_id,
  {_cos(2, "'Jo ' || CAST(bill_key AS VARCHAR)")} AS cosponsor_fn,
  {_cos(1, "'Last' || CAST(i AS VARCHAR)")} AS cosponsor_ln, {_cos(3, "'D'")} AS cosponsor_party,
  {_cos(4, "'TX'")} AS cosponsor_state,
  CASE WHEN {_UNREAD} THEN 'not a person: ' || raw_sponsor WHEN {_NO_NUMBER} THEN 'no bill number' END AS error_msg,
  CASE WHEN {_UNREAD} OR {_NO_NUMBER} THEN 'cosponsors' END AS ptransform
FROM (SELECT *, unnest(range(1, 2 + bill_key % 3)) AS i FROM {f('raw_bills')})"""
ORACLE["amendment_listing_html"] = """
SELECT 'https://www.congress.gov/bill/115/hr/' || CAST(c_custkey AS VARCHAR) || '/amendments?pageSort=asc' AS bill_url,
  CAST(i AS INTEGER) AS ordinal, 'HAMDT' || CAST(c_custkey * 10 + i AS VARCHAR) AS amdt_id,
  CAST(NULL AS VARCHAR) AS error_msg, CAST(NULL AS VARCHAR) AS ptransform
FROM (SELECT c_custkey, unnest(range(1, 7)) AS i FROM customer)"""

# nested pages say the same
for _name in ("house_roster", "house_roll_index", "senate_vote_menu", "bill_search", "bill_details", "cosponsors", "amendment_listing"):
    ORACLE[f"{_name}_nested"] = ORACLE[f"{_name}_html"]

# ---- feeds -----------------------------------------------------------------------------------

_VOTES = f"""SELECT * REPLACE (CASE WHEN missing AND matches = 1 THEN found ELSE first_name END AS first_name),
  NOT {_INT} AS bad_int, missing AND matches <> 1 AS bad_name
FROM ({_house('SELECT * EXCLUDE (vote_id) FROM ' + f('votes'))})"""
_VOTES = scrubbed(nicknamed(scrubbed(_VOTES, "first_name", "s1")), "last_name", "s2")
_VOTE_TEXTS = none("bill_id", "amdt_id", "first_name", "last_name", "party", "state")
ORACLE["votes_clean"] = f"""
SELECT {_VOTE_TEXTS}, CAST(vote_cast AS INTEGER) AS vote_cast, CAST(vote_date AS DATE) AS vote_date, chamber
FROM ({_VOTES}) WHERE NOT bad_int AND NOT bad_name"""
ORACLE["votes_errors"] = f"""
SELECT bill_id, coalesce(amdt_id, 'None') AS amdt_id, first_name, last_name, party, state,
  vote_cast, vote_date, chamber,
  CASE WHEN NOT bad_name THEN {_BAD} WHEN matches > 1 THEN '{_MANY_POLS}' ELSE '{_NO_POLS}' END AS error_msg,
  CASE WHEN bad_name THEN 'FixHouseFirstNameFn' ELSE 'FixTypesFn' END AS ptransform, 'bill_votes' AS script
FROM ({_VOTES}) WHERE bad_int OR bad_name"""

# the sponsor's columns as the common ones, as far as the row got
_BILL_ROWS = f"""SELECT bill_id, amdt_id, bill_title, bill_summary, bill_url, sponsor_fn AS first_name,
  sponsor_ln AS last_name, sponsor_party, sponsor_state, sponsor_fn IS NULL OR sponsor_state IS NULL AS bad,
  sponsor_ln AS raw_ln FROM {f('bills')}"""
_BILL_ROWS = scrubbed(nicknamed(scrubbed(_BILL_ROWS, "first_name", "s1")), "last_name", "s2")
ORACLE["bills_clean"] = f"""
SELECT {none('bill_id', 'amdt_id', 'bill_title', 'bill_summary')}, nullif(first_name, 'None') AS sponsor_fn,
  nullif(last_name, 'None') AS sponsor_ln, {none(_PA, _ST, 'bill_url')} FROM ({_BILL_ROWS}) WHERE NOT bad"""
ORACLE["bills_errors"] = f"""
SELECT bill_id, amdt_id, bill_title, coalesce(bill_summary, 'None') AS bill_summary,
  coalesce(first_name, 'None') AS sponsor_fn,
  CASE WHEN first_name IS NULL THEN raw_ln ELSE last_name END AS sponsor_ln,
  sponsor_party, coalesce(sponsor_state, 'None') AS sponsor_state, bill_url,
  'missing value: ' || CASE WHEN first_name IS NULL THEN 'first_name' ELSE 'state' END AS error_msg,
  'RevertAttributesFn' AS ptransform, 'bill_info' AS script FROM ({_BILL_ROWS}) WHERE bad"""

# how far the renames get: each column only when all before it are there
_F, _L, _P, _S = (f"cosponsor_{x}" for x in ("fn", "ln", "party", "state"))
_COS_ROWS = f"""SELECT bill_id, amdt_id, {_F} AS first_name, CASE WHEN {_F} IS NOT NULL THEN {_L} END AS last_name,
  CASE WHEN {_F} IS NOT NULL AND {_L} IS NOT NULL THEN {_P} END AS party,
  CASE WHEN {_F} IS NOT NULL AND {_L} IS NOT NULL AND {_P} IS NOT NULL THEN {_S} END AS state,
  {_F} IS NULL OR {_L} IS NULL OR {_P} IS NULL OR {_S} IS NULL AS bad,
  CASE WHEN {_F} IS NULL OR {_L} IS NULL THEN 'ScrubLnameFn' ELSE 'NormalizeAttributesFn' END AS step,
  CASE WHEN {_F} IS NULL OR {_L} IS NULL THEN 'missing value: last_name'
    WHEN {_P} IS NULL THEN 'missing value: cosponsor_party' ELSE 'missing value: cosponsor_state' END AS msg
FROM {f('cosponsors')}"""
_COS_ROWS = scrubbed(nicknamed(scrubbed(_COS_ROWS, "first_name", "s1")), "last_name", "s2")
ORACLE["cosponsors_clean"] = f"""
SELECT {none('bill_id', 'amdt_id', 'first_name', 'last_name', 'party', 'state')} FROM ({_COS_ROWS}) WHERE NOT bad"""
ORACLE["cosponsors_errors"] = "SELECT " + ", ".join(
    f"coalesce({c}, 'None') AS {c}" for c in ("bill_id", "amdt_id", "first_name", "last_name", "party", "state")
) + f", msg AS error_msg, step AS ptransform, 'cosponsors' AS script FROM ({_COS_ROWS}) WHERE bad"
ORACLE["error_csv"] = ORACLE["cosponsors_errors"]

_MEMBERS = _mapped(_resolved_members("SELECT * FROM " + f("members")))
ORACLE["house_clean"] = _house_rows("SELECT * FROM " + f("members"), RUN_DATE)
ORACLE["house_new"] = _unknown(
    f"SELECT {_PERSON}, initials AS state, suffix, nickname FROM ({_MEMBERS}) WHERE states = 1",
    "first_name, last_name, party, state, suffix, nickname")
ORACLE["house_errors"] = f"""
SELECT CASE WHEN first_name = 'None' THEN 'None' ELSE first_name END AS first_name, last_name, party, state,
  coalesce(suffix, 'None') AS suffix, coalesce(nickname, 'None') AS nickname, {_STATE_MSG} AS error_msg,
  'StateMapFn' AS ptransform, 'house_members' AS script FROM ({_MEMBERS}) WHERE states <> 1"""
ORACLE["house_dated_clean"] = _house_rows("SELECT * FROM " + f("members"), "2018-10-23", True)
_SENATE = _resolved_members("SELECT * FROM " + f("members"))
ORACLE["senate_clean"] = f"SELECT {_PERSON}, state, DATE '{RUN_DATE}' AS date FROM ({_SENATE})"
ORACLE["senate_new"] = _unknown(
    f"SELECT {_PERSON}, replace(state, 'NATION_', 'S') AS state, suffix, nickname FROM ({_SENATE})",
    "first_name, last_name, party, state, suffix, nickname")
_STORED = f"""SELECT * REPLACE (CASE WHEN first_name = 'Joseph' THEN 'Joe' ELSE first_name END AS first_name)
  FROM {f('politicians')}"""
ORACLE["revise_names"] = f"""
SELECT p.id, coalesce(k.full_name, p.first_name) AS first_name, p.last_name, p.party, p.state, p.suffix,
  CASE WHEN k.full_name IS NOT NULL THEN p.first_name ELSE p.nickname END AS nickname
FROM ({_STORED}) p LEFT JOIN (SELECT nickname AS nk, min(full_name) AS full_name FROM {f('nicknames')} GROUP BY 1) k
  ON p.first_name = k.nk"""

ORACLE["revise_names_touched"] = ORACLE["revise_names"]

# ---- streams ---------------------------------------------------------------------------------

ORACLE["stream_votes_clean"] = ORACLE["votes_clean"]
# NULL, and a text None, are left out of these messages
ORACLE["stream_cosponsors_errors"] = ORACLE["cosponsors_errors"]
ORACLE["stream_house_new"] = ORACLE["house_new"]
ORACLE["stream_bills_clean"] = ORACLE["bills_clean"]
ORACLE["stream_senate_clean"] = ORACLE["senate_clean"]
_TEXT_ROWS = scrubbed(nicknamed(scrubbed(f"""SELECT bill_id, amdt_id, coalesce({_F}, '') AS first_name,
  coalesce({_L}, '') AS last_name, coalesce({_P}, '') AS party, coalesce({_S}, '') AS state
  FROM {f('cosponsors')}""", "first_name", "s1")), "last_name", "s2")
ORACLE["stream_csv_cosponsors"] = f"""
SELECT {none('bill_id', 'amdt_id', 'first_name', 'last_name', 'party', 'state')} FROM ({_TEXT_ROWS})"""
ORACLE["stream_error_topics"] = ORACLE["cosponsors_errors"]

ORACLE["document_files"] = """
SELECT CAST(page_id % 40 AS BIGINT) AS file, string_agg(CAST(page_id AS VARCHAR) || chr(10), '' ORDER BY page_id) AS body
FROM pages GROUP BY 1"""
_NO_ERROR = "CAST(NULL AS VARCHAR) AS error_msg, CAST(NULL AS VARCHAR) AS ptransform"
ORACLE["landed_votes"] = f"""
SELECT bill_id, amdt_id, first_name, ' ' || last_name || chr(10) || 'x ' AS last_name, party, state, vote_cast, vote_date,
  chamber, chamber_state, {_NO_ERROR} FROM {f("votes")}"""
ORACLE["landed_senate"] = f"""
SELECT first_name, last_name, party, state, {_NO_ERROR} FROM {f("members")}"""
ORACLE["landed_layouts"] = f"""
SELECT first_name, last_name, party, state, district, CASE WHEN member_id % 2 = 1 THEN '2018-10-20' ELSE '' END AS date,
  {_NO_ERROR} FROM {f("members")}"""
ORACLE["decoded_references"] = """
SELECT p_partkey, 'O\u2019' || p_name || ' ''x'' Vel\u00e1z &lt; &amp; \u2019 &none; A&B' AS name FROM part"""
ORACLE["votes_date_errors"] = f"""
SELECT bill_id, amdt_id, 'Kim' AS first_name, replace(last_name, ' Jr.', '') AS last_name, party, state, '1' AS vote_cast,
  'on ' || vote_date AS vote_date, chamber, 'invalid date: ''on ' || vote_date || '''' AS error_msg,
  'FixTypesFn' AS ptransform, 'bill_votes' AS script FROM {f("votes")} WHERE bill_id LIKE '%7'"""
ORACLE["stream_stored_senate"] = ORACLE["senate_clean"]
ORACLE["landed_votes_split"] = ORACLE["landed_votes"]
ORACLE["house_first_name_intervals"] = ORACLE["house_first_name"]
ORACLE["member_intervals"] = f"""
WITH days AS (SELECT first_name, last_name, party, state, date, count(*) AS copies FROM {f('house')} GROUP BY ALL),
marked AS (SELECT *, lag(date) OVER member IS DISTINCT FROM CAST(date - INTERVAL 1 DAY AS DATE) AS starts FROM days
  WINDOW member AS (PARTITION BY first_name, last_name, party, state, copies ORDER BY date)),
runs AS (SELECT *, sum(CAST(starts AS INTEGER)) OVER (PARTITION BY first_name, last_name, party, state, copies ORDER BY date) AS run FROM marked)
SELECT first_name, last_name, party, state, copies, min(date) AS from_date, max(date) AS to_date
FROM runs GROUP BY first_name, last_name, party, state, copies, run"""
ORACLE["transliterate_scripts"] = """
SELECT c_custkey AS member_id, CASE c_custkey % 8 WHEN 0 THEN 'Shchukin Il''ia' WHEN 1 THEN 'Papadopoylos' WHEN 2 THEN 'shlvm'
    WHEN 3 THEN 'khald bn shakr' WHEN 4 THEN 'kyoutossho katta' WHEN 5 THEN 'hanguk gim' WHEN 6 THEN 'Lukasz AEgir' ELSE 'Plokhoi Ezh 中' END ||
  ' ' || CAST(c_custkey AS VARCHAR) AS name
FROM customer"""
ORACLE["load_repeated"] = f"""
SELECT first_name, last_name, party, state, district, date, CASE party WHEN 'D' THEN 'first' ELSE 'second' END AS run_id
FROM ({ORACLE['house_clean']}) WHERE party IN ('D', 'R')"""
ORACLE["stream_redelivered"] = ORACLE["house_clean"]


def _counts(source: str, failed: str) -> str:
    """Observed counts: all rows, clean ones, and the failed ones by step."""
    return f"""
SELECT step, CAST(n AS BIGINT) AS n FROM (
  SELECT 'rows' AS step, count(*) AS n FROM ({source})
  UNION ALL SELECT 'clean', (SELECT count(*) FROM ({source})) - (SELECT count(*) FROM ({failed}))
  UNION ALL SELECT ptransform, count(*) FROM ({failed}) GROUP BY 1) WHERE n > 0"""


ORACLE["house_counts"] = _counts(f"SELECT * FROM {f('members')}", ORACLE["house_errors"])
ORACLE["stream_cosponsors_counts"] = _counts(f"SELECT * FROM {f('cosponsors')}", ORACLE["stream_cosponsors_errors"])
