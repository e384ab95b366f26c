"""SQL twins of the registered queries, for DuckDB on the same tables.

They share the input texts of ``carriers`` and nothing else: numbers are printed from
decimals by string work, duplicates are counted by the plain OR condition, carry-forward
is a window, one-by-one admission a recursive walk.
"""

from __future__ import annotations

from tidemark.functions import rules as r
from tidemark.plans import carriers as c
from tidemark.plans import registry as q

# --- number texts -----------------------------------------------------------


def _grouped(number: str, least: int, most: int) -> str:
    """A non-negative decimal as grouped text with ``least`` to ``most`` decimals."""
    text = f"CAST(CAST(round({number}, {most}) AS DECIMAL(38,{most})) AS VARCHAR)"
    whole = f"format('{{:,}}', CAST(split_part({text}, '.', 1) AS BIGINT))"
    decimals = f"rtrim(split_part({text}, '.', 2), '0')"
    if least:
        decimals = f"rpad({decimals}, CAST(greatest({least}, length({decimals})) AS INTEGER), '0')"
    return f"{whole} || CASE WHEN {decimals} = '' THEN '' ELSE '.' || {decimals} END"


def _compact(number: str, least: int) -> str:
    cases = []
    for shift, unit in ((0, ""), (3, "K"), (6, "M"), (9, "B"), (12, "T")):
        scale = "1" if shift == 0 else f"CAST(1e-{shift} AS DECIMAL({shift + 1},{shift}))"
        scaled = f"CAST(CAST({number} AS DECIMAL(25,8)) * {scale} AS DECIMAL(38,{min(8 + shift, 20)}))"
        rounded = f"round({scaled}, 2)"
        text = f"({_grouped(scaled, least, 2)}) || '{unit}'"
        if shift == 12:
            cases.append(f"WHEN {rounded} < 10000 THEN replace({text}, ',', '') ELSE {text}")
        else:
            cases.append(f"WHEN {rounded} < 1000 THEN {text}")
    return f"CASE {' '.join(cases)} END"


def _sign(number: str) -> str:
    return f"CASE WHEN {number} < 0 THEN '-' ELSE '' END"


def money(number: str) -> str:
    plain = f"{_sign(number)} || '$' || {_grouped(f'abs({number})', 2, 6)}"
    return (
        f"CASE WHEN ({number}) IS NULL THEN 'N/A' WHEN ({number}) < 1 THEN {plain} "
        f"ELSE '$' || {_compact(number, 2)} END"
    )


def percent(value: str) -> str:
    """fmt's ``.2f`` is exact in binary; only its exact ties go to even and are redone."""
    v = f"({value})"
    tie = f"(abs({v} * 8) % 2 = 1)"
    away = f"CAST(CAST(round(CAST({v} AS DECIMAL(30,3)), 2) AS DECIMAL(30,2)) AS VARCHAR)"
    digits = f"CASE WHEN {tie} THEN {away} ELSE format('{{:.2f}}', {v}) END"
    return (
        f"CASE WHEN {v} IS NULL THEN 'N/A' ELSE CASE WHEN {v} >= 0 THEN '+' ELSE '' END "
        f"|| {digits} || '%' END"
    )


def number(value: str) -> str:
    return (
        f"CASE WHEN ({value}) IS NULL THEN 'N/A' "
        f"ELSE {_sign(value)} || {_grouped(f'abs({value})', 0, 3)} END"
    )


def supply(value: str, symbol: str) -> str:
    return (
        f"CASE WHEN ({value}) IS NULL THEN 'N/A' ELSE {_sign(value)} || "
        f"{_compact(f'abs({value})', 0)} || ' ' || upper({symbol}) END"
    )


# --- inputs -----------------------------------------------------------------

_AMOUNTS = ", ".join(f"{sql} AS {name}" for name, sql in c.ASSET_AMOUNTS_SQL.items())
_TEXTS = ", ".join(f"{sql} AS {name}" for name, sql in c.ASSET_TEXTS_SQL.items())

ASSETS = f"""ordered AS (
  SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS cap,
         CAST(count(*) AS DECIMAL(18,0)) AS volume
  FROM orders GROUP BY o_custkey
), assets AS (
  SELECT {_TEXTS}, CASE WHEN {c.HAS_CAP_SQL} THEN cap END AS market_cap,
         CASE WHEN {c.HAS_CAP_SQL} THEN volume END AS total_volume, {c.CHANGE_SQL} AS pct, {c.RANK_SQL} AS rank,
         {_AMOUNTS}, {c.QUOTE_SQL} AS quote
  FROM customer LEFT JOIN ordered ON c_custkey = o_custkey
)"""

_BY_CAP = "ORDER BY market_cap DESC NULLS LAST, id"

TABLE_VIEW = f"""id, image, name, upper(symbol) AS symbol, {money('current_price')} AS price_text,
  {percent('coalesce(pct, 0.0E0)')} AS change_text,
  CASE WHEN coalesce(pct, 0) >= 0 THEN 'up' ELSE 'down' END AS direction,
  {money('market_cap')} AS cap_text, {money('total_volume')} AS volume_text,
  '#' || coalesce(CAST(rank AS VARCHAR), '') AS rank_text"""
CARD_VIEW = f"""id, image, name, upper(symbol) AS symbol,
  {percent('coalesce(pct, 0.0E0)')} AS change_text, {money('current_price')} AS price_text,
  {money('market_cap')} AS cap_text"""


def _kpis(source: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return f"""totals AS (
  SELECT {keys}coalesce(sum(market_cap), 0) AS cap, coalesce(sum(total_volume), 0) AS volume,
         CAST(count(*) FILTER (WHERE pct > 0) AS BIGINT) AS gainer_count,
         CAST(count(*) AS BIGINT) AS asset_count
  FROM {source}{group}
) SELECT {keys}CAST(cap AS DOUBLE) AS cap_total, CAST(volume AS DOUBLE) AS volume_total,
  gainer_count, asset_count, {money('CAST(cap AS DECIMAL(30,2))')} AS cap_text,
  {money('CAST(volume AS DECIMAL(30,2))')} AS volume_text,
  gainer_count || '/' || asset_count AS gainers_text FROM totals"""


def _snapshots(unit: str) -> str:
    return f"""stamped AS (
  SELECT CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS snapshot_ts, * FROM events
), snapshots AS (
  SELECT snapshot_ts, CAST(user_id AS VARCHAR) AS id,
         last(value ORDER BY ts, event_id) AS current_price,
         sum(CAST(value AS DECIMAL(18,2))) AS market_cap,
         CAST(count(*) AS DECIMAL(18,0)) AS total_volume,
         last(value ORDER BY ts, event_id) - 50.0 AS pct
  FROM stamped GROUP BY snapshot_ts, user_id
)"""


_SNAPSHOT_ROW = (
    "current_price, CAST(market_cap AS DOUBLE) AS market_cap, "
    "CAST(total_volume AS DOUBLE) AS total_volume"
)
_NEWEST = "SELECT * FROM snapshots WHERE snapshot_ts = (SELECT max(snapshot_ts) FROM snapshots)"

_FETCHES = ", ".join(
    f"({n}, {week}, {hours}, '{kind}')" for n, (week, hours, kind) in enumerate(c.FETCHES)
)
# A fetch is applied if its body can be read and no newer one was applied before it.
_REFRESHED = f"""{_snapshots('week')}, weeks AS (
  SELECT snapshot_ts, row_number() OVER (ORDER BY snapshot_ts) AS week
  FROM (SELECT DISTINCT snapshot_ts FROM snapshots)
), fetches(n, week, hours, kind) AS (VALUES {_FETCHES}
), tries AS (
  SELECT n, kind, snapshot_ts, snapshot_ts + hours * INTERVAL 1 HOUR AS fetched_at
  FROM fetches JOIN weeks USING (week)
), readable AS (
  SELECT *, max(fetched_at) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
  FROM tries WHERE kind IN ('good', 'empty')
), applied AS (
  SELECT n, fetched_at, CASE WHEN kind = 'good' THEN snapshot_ts END AS snapshot_ts
  FROM readable WHERE seen IS NULL OR fetched_at > seen
), newest AS (SELECT * FROM applied ORDER BY n DESC LIMIT 1
), shown AS (
  SELECT snapshots.*, newest.fetched_at FROM newest JOIN snapshots USING (snapshot_ts)
), versions AS (
  SELECT id, market_cap, n FROM applied JOIN snapshots USING (snapshot_ts)
), picked AS (
  SELECT id, -1 AS n, market_cap FROM snapshots JOIN weeks USING (snapshot_ts)
  WHERE week = 1 AND {c.SELECTED_SQL}
), kept AS (
  SELECT id, arg_max(market_cap, n) AS market_cap FROM (
    SELECT id, n, market_cap FROM picked
    UNION ALL SELECT id, n, market_cap FROM versions WHERE id IN (SELECT id FROM picked)
  ) GROUP BY id
), unreadable AS (
  SELECT count(*) AS n FROM tries JOIN snapshots USING (snapshot_ts)
  WHERE kind = 'broken' AND {c.CUT_SQL}
), sizes AS (SELECT snapshot_ts, count(*) AS n_assets FROM snapshots GROUP BY snapshot_ts
), kpi AS ({_kpis('shown').replace('totals AS (', 'WITH totals AS (', 1)})"""
_NO_TIME, _NO_TEXT = "CAST(NULL AS TIMESTAMP)", "CAST(NULL AS VARCHAR)"

# --- cleansing and rules ----------------------------------------------------

_FORM_BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(0) || chr(11)"
_SEARCH_BLANKS = " || ".join(
    f"chr({code})"
    for code in (
        9, 10, 11, 12, 13, 32, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288, 65279
    )
)


def unslashed(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(trim({text}, {_FORM_BLANKS}), "
        "chr(92) || chr(92)), lambda p: replace(replace(p, chr(92) || '0', chr(0)), chr(92), '')),"
        " chr(92))"
    )


def escaped(text: str, quotes: bool = True) -> str:
    pairs = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")]
    if quotes:
        pairs.append(("''", "&#039;"))
    for plain, code in pairs:
        text = f"replace({text}, '{plain}', '{code}')"
    return text


def cleansed(text: str) -> str:
    return escaped(unslashed(text))


def _empty(raw: str) -> str:
    return f"({raw} IS NULL OR {raw} IN ('', '0'))"


def _or_blank(raw: str) -> str:
    return f"CASE WHEN {_empty(raw)} THEN '' ELSE {cleansed(raw)} END"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _bad_email(text: str) -> str:
    return (
        f"NOT (length({text}) <= 254 AND length(split_part({text}, '@', 1)) <= 64 "
        f"AND regexp_matches({text}, {_quoted(r.EMAIL)}))"
    )


_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _lacks(text: str, pattern: str) -> str:
    return f"NOT regexp_matches({text}, {_quoted(pattern)})"


def _signup_cases(strict: bool) -> list[tuple[str, str, str, str]]:
    """(rule, field, severity, broken) over raw columns and cleansed ones named c_*."""
    secret = "x_secret" if strict else "c_spassword"

    def filled(raw: str, broken: str) -> str:
        return f"NOT {_empty(raw)} AND {broken}"

    unchosen = "(state IS NULL OR state IN ('', 'Select an option'))"
    listed = ", ".join(_quoted(s) for s in r.STATES)
    return [
        ("V1", "ftname", "B", _empty("ftname")),
        ("V2", "ftname", "B", filled("ftname", _lacks("c_ftname", r.NAME))),
        ("V3", "ltname", "B", _empty("ltname")),
        ("V4", "ltname", "B", filled("ltname", _lacks("c_ltname", r.NAME))),
        ("V5", "email", "B", _empty("email")),
        ("V6", "email", "B", filled("email", _bad_email("c_email"))),
        ("V7", "address", "B", _empty("address")),
        ("V24", "address", "w", "length(address) > 90"),
        ("V8", "Phonenumber", "B", _empty("Phonenumber")),
        ("V9", "Phonenumber", "B", filled("Phonenumber", _lacks("c_Phonenumber", r.PHONE))),
        ("V24", "Phonenumber", "w", "length(Phonenumber) > 10"),
        ("V10", "state", "B", unchosen),
        ("V11", "state", "B" if strict else "w", f"NOT {unchosen} AND state NOT IN ({listed})"),
        ("V12", "spassword", "B", _empty("spassword")),
        ("V13", "spassword", "B", filled("spassword", f"strlen({secret}) < 8")),
        ("V14", "spassword", "B", filled("spassword", _lacks(secret, r.DIGIT))),
        ("V15", "spassword", "B", filled("spassword", _lacks(secret, r.CAPITAL))),
        ("V16", "spassword", "B", filled("spassword", _lacks(secret, r.SMALL))),
        ("V17", "spassword", "B", filled("spassword", _lacks(secret, r.SPECIAL))),
        ("V18", "conpassword", "B" if strict else "w", _empty("conpassword")),
        ("V19", "conpassword", "B", filled("conpassword", "c_spassword <> c_conpassword")),
    ]


_ONE_EACH = "SELECT c_custkey AS submission_id, " + ", ".join(
    f"{sql} AS {name}" for name, sql in c.SIGNUP_SQL.items()
) + " FROM customer"


def _signups(strict: bool = False, match: str = "= 1", raw: str = _ONE_EACH) -> str:
    clean = []
    for name in c.SIGNUP_SQL:
        text = _or_blank(name)
        if name == "email":
            text = f"translate({text}, {_ASCII})"
        clean.append(f"{text} AS c_{name}")
    cases = _signup_cases(strict)
    broken = ", ".join(f"CASE WHEN {b} THEN '{v}:{f}' END" for v, f, _, b in cases)
    blocked = " OR ".join(f"coalesce({b}, false)" for _, _, s, b in cases if s == "B")
    return f"""known AS (
  SELECT {c.KNOWN_EMAIL_SQL} AS k_email, sha256({c.KNOWN_SECRET_SQL}) AS k_secret
  FROM customer WHERE {c.KNOWN_SQL}
), raw AS ({raw}
), clean AS (SELECT *, {', '.join(clean)}, {unslashed('spassword')} AS x_secret FROM raw
), matched AS (
  SELECT *, (SELECT count(*) FROM known WHERE k_email = c_email
             OR k_secret = sha256(c_conpassword)) {match} AS taken FROM clean
), judged AS (
  SELECT *, array_to_string(list_filter([{broken}, CASE WHEN taken THEN 'V20:email' END],
         lambda v: v IS NOT NULL), ',') AS broken, NOT ({blocked} OR taken) AS accepted
  FROM matched
)"""


_MEMBER_ROW = """submission_id AS member_id, c_ftname || ' ' || c_ltname AS member_name,
  c_email AS email, c_Phonenumber AS phone_number, c_address AS address,
  CASE WHEN state IS NULL OR state = 'Select an option' THEN '' ELSE state END AS state,
  CAST(NULL AS INTEGER) AS selling_quantity, sha256(c_conpassword) AS password_digest"""


def _has(rule: str, field: str) -> str:
    return f"list_contains(string_split(broken, ','), '{rule}:{field}')"


def _first_message(field: str, *found: str) -> str:
    cases = " ".join(
        f"WHEN {_has(v, field)} THEN {_quoted(r.SIGNUP_MESSAGES[v])}" for v in found
    )
    return f"CASE {cases} ELSE '' END"


_PASSWORD_TEXT = (
    f"CASE WHEN {_has('V12', 'spassword')} THEN {_quoted(r.SIGNUP_MESSAGES['V12'])} ELSE "
    + " || ".join(
        f"CASE WHEN {_has(v, 'spassword')} THEN {_quoted(r.SIGNUP_MESSAGES[v] + '<br>')} "
        "ELSE '' END"
        for v in ("V13", "V14", "V15", "V16", "V17")
    )
    + " END"
)

_CONTACT_FIELDS = ", ".join(f"{sql} AS {name}" for name, sql in c.CONTACT_SQL.items())
_CONTACT_CASES = [
    ("V1", _empty("firstname")),
    ("V2", f"NOT {_empty('firstname')} AND {_lacks('c_firstname', r.NAME)}"),
    ("V3", _empty("lastname")),
    ("V4", f"NOT {_empty('lastname')} AND {_lacks('c_lastname', r.NAME)}"),
    ("V5", _empty("mailid")),
    ("V6", f"NOT {_empty('mailid')} AND {_bad_email('c_mailid')}"),
    ("V21", _empty("subject")),
    ("V22", f"NOT {_empty('subject')} AND {_lacks('c_subject', r.SUBJECT)}"),
]
_CONTACT_MESSAGES = " || ".join(
    f"CASE WHEN {b} THEN {_quoted(r.CONTACT_MESSAGES[v])} || chr(92) || 'n' ELSE '' END"
    for v, b in _CONTACT_CASES
)
CONTACTS = f"""raw AS (SELECT {c.CONTACT_ID_SQL} AS submission_id, {_CONTACT_FIELDS}
  FROM conversations
), clean AS (
  SELECT *, {', '.join(f'{_or_blank(n)} AS c_{n}' for n in c.CONTACT_SQL if n != 'description')},
         coalesce({cleansed('description')}, '') AS c_description FROM raw
), told AS (SELECT *, {_CONTACT_MESSAGES} AS told FROM clean)"""

# --- identity ---------------------------------------------------------------

IDENTITY = f"""members AS (
  SELECT c_custkey AS member_id, {c.EMAIL_SQL} AS m_email, sha256({c.SECRET_SQL}) AS m_secret
  FROM customer WHERE c_custkey % 2 = 0
), candidates AS (
  SELECT c_custkey AS candidate_id, {c.EMAIL_SQL} AS email, sha256({c.SECRET_SQL}) AS secret
  FROM customer
), counted AS (
  SELECT *, (SELECT count(*) FROM members WHERE m_email = email OR m_secret = secret)
         AS n_matches FROM candidates
)"""

ATTEMPTS = f"""attempts AS (
  SELECT o_orderkey AS attempt_id, {c.ATTEMPT_EMAIL_SQL} AS email, {c.ATTEMPT_SECRET_SQL} AS pass
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

# --- positions --------------------------------------------------------------

_SECTIONS = ", ".join(f"({o}, '{s}', {top - 150}, {top - 150 + h})" for o, s, top, h in c.SECTIONS)
_LINKS = ", ".join(f"({o}, '{href}')" for o, href in c.LINKS)

POSITIONS = f"""sections(ord, section_id, lo, hi) AS (VALUES {_SECTIONS}
), scroll AS (
  SELECT user_id AS session_id, ts, event_id, value AS scroll_y FROM events
), hits AS (
  SELECT event_id, arg_max(section_id, ord) AS section_id
  FROM scroll JOIN sections ON scroll_y >= lo AND scroll_y < hi GROUP BY event_id
), sectioned AS (SELECT scroll.*, section_id FROM scroll LEFT JOIN hits USING (event_id))"""


def _carried(session: str) -> str:
    return (
        "coalesce(last_value(section_id IGNORE NULLS) OVER "
        f"(PARTITION BY {session} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 'home')"
    )


_CARRY = f"SELECT session_id, event_id, {_carried('session_id')} AS active_section FROM sectioned"
_LONG = ", ".join(f"{sql} AS {name}" for name, sql in c.LONG_SECTIONS_SQL.items())

_SEARCHED = "contains(lower(name), 'household') OR contains(lower(symbol), 'household')"

_SIGNED = {
    name: f"WITH {_signups()} SELECT {_MEMBER_ROW} FROM judged WHERE accepted"
    for name in ("signup_accepted", "stream_signup")
}
_CONTACTED = {
    name: f"""WITH {CONTACTS} SELECT c_firstname || ' ' || c_lastname AS name, c_mailid AS mailid,
  c_subject AS subject, c_description AS description FROM told WHERE told = ''"""
    for name in ("contact_accepted", "stream_contact")
}

_AUDIT = f"""WITH {IDENTITY}, {ATTEMPTS}, admins AS (
  SELECT {c.ADMIN_EMAIL_SQL} AS a_email, sha256({c.ADMIN_SECRET_SQL}) AS a_secret FROM supplier
) SELECT attempt_id, CASE
  WHEN EXISTS (SELECT 1 FROM members WHERE m_email = lower(email) AND m_secret = sha256(pass))
    THEN 'member'
  WHEN EXISTS (SELECT 1 FROM admins WHERE a_email = lower(email) AND a_secret = sha256(pass))
    THEN 'admin' ELSE 'denied' END AS outcome FROM attempts"""
_AUDITED = dict.fromkeys(("login_audit", "login_audit_files"), _AUDIT)

# One after another, with the emails and secrets taken so far.
_WALK = """walk AS (
  SELECT CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS candidate_id, false AS taken,
         CAST([] AS VARCHAR[]) AS es, CAST([] AS VARCHAR[]) AS ss
  UNION ALL
  SELECT queue.n, queue.candidate_id, NOT (list_contains(es, e) OR list_contains(ss, s)),
         CASE WHEN list_contains(es, e) OR list_contains(ss, s) THEN es ELSE list_append(es, e) END,
         CASE WHEN list_contains(es, e) OR list_contains(ss, s) THEN ss ELSE list_append(ss, s) END
  FROM walk JOIN queue ON queue.n = walk.n + 1
)"""

ORACLE: dict[str, str] = {
    "market_kpis": f"WITH {ASSETS}, {_kpis('assets')}",
    "market_json_source": f"WITH {ASSETS}, {_kpis('assets')}",
    "market_quote": f"""WITH {ASSETS}, quoted AS (SELECT * FROM assets WHERE quote = 'usd'),
{_kpis('quoted')}""",
    "market_top20": f"WITH {ASSETS} SELECT {TABLE_VIEW} FROM assets {_BY_CAP} LIMIT 20",
    "market_page2": f"WITH {ASSETS} SELECT {CARD_VIEW} FROM assets {_BY_CAP} LIMIT 20 OFFSET 20",
    "market_deep_page": f"""WITH {ASSETS} SELECT id, name, CAST(market_cap AS DOUBLE) AS market_cap
FROM assets {_BY_CAP} LIMIT 20 OFFSET 80""",
    "market_rank": f"""WITH {ASSETS} SELECT id, CAST(market_cap AS DOUBLE) AS market_cap,
  row_number() OVER ({_BY_CAP}) AS market_cap_rank FROM assets""",
    "market_search": f"WITH {ASSETS} SELECT id, name, symbol FROM assets WHERE {_SEARCHED}",
    "market_search_literal": f"""WITH {ASSETS} SELECT id, name, symbol FROM assets
WHERE contains(lower(name), 'r#00000001') OR contains(lower(symbol), 'r#00000001')""",
    "market_search_blank": f"WITH {ASSETS} SELECT id, name, symbol FROM assets",
    "market_find": f"""WITH {ASSETS} SELECT id, name, CAST(current_price AS DOUBLE) AS current_price
FROM assets WHERE id = '42'""",
    "market_direction": f"""WITH {ASSETS} SELECT id, coalesce(pct, 0.0E0) AS change,
  CASE WHEN coalesce(pct, 0) >= 0 THEN 'up' ELSE 'down' END AS direction FROM assets""",
    "market_table": f"WITH {ASSETS} SELECT {TABLE_VIEW} FROM assets",
    "market_cards": f"WITH {ASSETS} SELECT {CARD_VIEW} FROM assets",
    "market_detail_long": f"WITH {ASSETS} "
    + " UNION ALL ".join(
        f"SELECT id, {n} AS ord, '{label}' AS label, {text} AS value FROM assets"
        for n, (label, text) in enumerate(
            (
                ("Current Price", money("current_price")),
                ("24h Change", percent("coalesce(pct, 0.0E0)")),
                ("24h High", money("high_24h")),
                ("24h Low", money("low_24h")),
                ("Market Cap", money("market_cap")),
                ("Total Volume", money("total_volume")),
                ("Circulating Supply", supply("circulating_supply", "symbol")),
                ("Total Supply", supply("total_supply", "symbol")),
                ("Max Supply", supply("max_supply", "symbol")),
                ("ATH", money("ath")),
                ("ATL", money("atl")),
                ("Rank", f"'#' || {number('CAST(rank AS DECIMAL(18,0))')}"),
            ),
            start=1,
        )
    ),
    "market_status": f"""WITH {ASSETS}, found AS (SELECT count(*) AS n FROM assets WHERE {_SEARCHED})
SELECT 'found' AS run, CASE WHEN n = 0 THEN 'empty' ELSE 'data' END AS status, n AS shown FROM found
UNION ALL SELECT 'nothing', 'empty', 0
UNION ALL SELECT 'failed', 'error', n FROM found""",
    "fmt_compact_currency": f"""WITH v AS (SELECT o_orderkey, {q.MONEY_SQL} AS v FROM orders)
SELECT o_orderkey, {money('v')} AS text FROM v""",
    "fmt_percent": f"""SELECT l_orderkey, l_linenumber, {percent(q.PERCENT_SQL)} AS text,
  {percent(q.TIE_SQL)} AS tie_text FROM lineitem""",
    "fmt_number": f"""WITH v AS (SELECT l_orderkey, l_linenumber, {q.NUMBER_SQL} AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, {number('v')} AS text FROM v""",
    "fmt_supply": f"""WITH {ASSETS} SELECT id, {supply('circulating_supply', 'symbol')} AS circulating,
  {supply('max_supply', 'symbol')} AS maximum FROM assets""",
    "fmt_rank": f"""WITH {ASSETS} SELECT id,
  '#' || {number('CAST(rank AS DECIMAL(18,0))')} AS detail,
  '#' || coalesce(CAST(rank AS VARCHAR), '') AS in_table FROM assets""",
    "fmt_time": f"""SELECT event_id,
  coalesce(strftime({q.FRESH_SQL}, '%-I:%M:%S %p'), 'pending') AS text FROM events""",
    "cn_join": """SELECT o_orderkey, 'order'
  || CASE WHEN o_orderpriority = '1-URGENT' THEN ' urgent' ELSE '' END
  || CASE WHEN o_orderstatus = 'F' THEN '' ELSE ' ' || o_orderstatus END AS text FROM orders""",
    "cleanse_text": f"""WITH raw AS (SELECT page_id, {c.DIRTY_HTML_SQL} AS dirty FROM pages)
SELECT page_id, {cleansed('dirty')} AS text,
  {escaped(unslashed('dirty'), quotes=False)} AS text_old_quotes FROM raw""",
    "search_terms": f"""SELECT doc_id, lower(trim({c.PADDED_TEXT_SQL}, {_SEARCH_BLANKS})) AS text
FROM documents""",
    "signup_violations": f"WITH {_signups()} SELECT submission_id, broken, accepted FROM judged",
    "signup_violations_strict": f"""WITH {_signups(strict=True, match='>= 1')}
SELECT submission_id, broken, accepted FROM judged""",
    **_SIGNED,
    "signup_rejects": f"""WITH {_signups()} SELECT submission_id,
  {_first_message('ftname', 'V1', 'V2')} AS first_name_text,
  {_first_message('ltname', 'V3', 'V4')} AS last_name_text,
  {_first_message('email', 'V5', 'V6')} AS email_text,
  {_first_message('Phonenumber', 'V8', 'V9')} AS phone_text,
  {_first_message('address', 'V7')} AS address_text, {_PASSWORD_TEXT} AS password_text,
  {_first_message('conpassword', 'V18', 'V19')} AS confirm_text,
  {_first_message('state', 'V10')} AS state_text, {_quoted(r.SIGNUP_FAILED)} AS outcome
FROM judged WHERE NOT accepted""",
    "contact_messages": f"""WITH {CONTACTS} SELECT submission_id, told = '' AS accepted,
  CASE WHEN told <> '' THEN 'You must follow:' || chr(92) || 'n' || told END AS message FROM told""",
    **_CONTACTED,
    "login_warnings": f"""WITH {ATTEMPTS} SELECT attempt_id,
  CASE WHEN email IS NULL OR email = '' THEN 'V25:email' ELSE '' END AS broken,
  coalesce(email, '') AS email FROM attempts""",
    "dup_or_join": f"""WITH {IDENTITY} SELECT candidate_id, n_matches, n_matches = 1 AS duplicate
FROM counted""",
    "dup_any": f"WITH {IDENTITY} SELECT candidate_id FROM counted WHERE n_matches >= 1",
    "admit_new": f"WITH {IDENTITY} SELECT candidate_id, email FROM counted WHERE n_matches <> 1",
    "admit_new_any": f"WITH {IDENTITY} SELECT candidate_id, email FROM counted WHERE n_matches = 0",
    "admit_in_order": f"""WITH RECURSIVE queue AS (
  SELECT row_number() OVER (ORDER BY c_custkey) AS n, c_custkey AS candidate_id,
         {c.QUEUE_EMAIL_SQL} AS e, {c.QUEUE_SECRET_SQL} AS s FROM customer
), {_WALK} SELECT candidate_id FROM walk WHERE taken""",
    "stream_signup_waves": f"""WITH RECURSIVE {_signups(match='>= 1', raw=c.signup_waves_sql())},
queue AS (
  SELECT row_number() OVER (ORDER BY submission_id) AS n, submission_id AS candidate_id,
         c_email AS e, sha256(c_conpassword) AS s FROM judged WHERE accepted
), {_WALK} SELECT {_MEMBER_ROW} FROM judged
WHERE submission_id IN (SELECT candidate_id FROM walk WHERE taken)""",
    **_AUDITED,
    "first_per_key": """SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders
) WHERE rn = 1""",
    "section_range_join": f"WITH {POSITIONS} SELECT event_id, scroll_y, section_id FROM sectioned",
    "section_range_join_long": f"""WITH long AS (
  SELECT {_LONG} FROM part
), spots AS (SELECT event_id, {c.LONG_SCROLL_SQL} AS y FROM events)
SELECT event_id, arg_max(section_id, ord) AS section_id
FROM spots LEFT JOIN long ON y >= lo AND y < hi GROUP BY event_id""",
    "section_carry_forward": f"WITH {POSITIONS} {_CARRY}",
    "section_carry_forward_hot": f"""WITH {POSITIONS}
SELECT event_id, {_carried('1')} AS active_section FROM sectioned""",
    "sticky_flag": "SELECT event_id, value > 100 AS sticky FROM events",
    "nav_lookup": f"""WITH {POSITIONS}, links(ord, href) AS (VALUES {_LINKS}), carried AS ({_CARRY})
SELECT event_id, active_section, (SELECT arg_min(href, ord) FROM links
  WHERE contains(href, active_section)) AS href FROM carried""",
    "nav_lookup_long": """SELECT doc_id, (SELECT arg_min(url, page_id) FROM pages
  WHERE contains(url, '/' || lang || '/')) AS href FROM documents""",
    "latest_snapshot": f"WITH {_snapshots('day')} SELECT id, {_SNAPSHOT_ROW} FROM ({_NEWEST})",
    "kpis_per_snapshot": f"WITH {_snapshots('day')}, {_kpis('snapshots', 'snapshot_ts')}",
    "selection_retained": f"""WITH {_snapshots('day')}, picked AS (
  SELECT * FROM snapshots WHERE snapshot_ts = (SELECT min(snapshot_ts) FROM snapshots)
), newest AS ({_NEWEST}), kept AS (
  SELECT * FROM newest WHERE id IN (SELECT id FROM picked)
  UNION ALL SELECT * FROM picked WHERE id NOT IN (SELECT id FROM newest)
) SELECT id, snapshot_ts, {_SNAPSHOT_ROW} FROM kept""",
    "stream_latest_snapshot": f"""WITH {_snapshots('week')}
SELECT id, {_SNAPSHOT_ROW} FROM ({_NEWEST})""",
    "stream_sections": f"WITH {POSITIONS} SELECT event_id, session_id, active_section FROM ({_CARRY})",
    "stream_visits": f"""WITH {POSITIONS}, marked AS (
  SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY session_id ORDER BY ts, event_id)
                     > INTERVAL {c.VISIT_PAUSE} SECONDS, false) AS fresh FROM sectioned
), visited AS (
  SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY session_id ORDER BY ts, event_id
                                          ROWS UNBOUNDED PRECEDING) AS visit FROM marked
) SELECT event_id, session_id, min(ts) OVER (PARTITION BY session_id, visit) AS visit_start,
  {_carried('session_id, visit')} AS active_section FROM visited""",
    "stream_refresh_faults": f"""WITH {_REFRESHED}
SELECT 'asset' AS kind, id AS key, CAST(market_cap AS DOUBLE) AS amount, fetched_at AS at,
  {_NO_TEXT} AS text FROM shown
UNION ALL SELECT 'kpi', gainers_text, cap_total, {_NO_TIME}, cap_text FROM kpi
UNION ALL SELECT 'selected', id, CAST(market_cap AS DOUBLE), {_NO_TIME}, {_NO_TEXT} FROM kept
UNION ALL SELECT 'batch', CAST(tries.n AS VARCHAR),
  CASE WHEN applied.n IS NOT NULL THEN CAST(coalesce(n_assets, 0) AS DOUBLE) END, applied.fetched_at,
  CASE WHEN applied.n IS NOT NULL THEN 'shown' WHEN kind = 'refused'
  THEN 'Request failed with status 503.' WHEN kind = 'offline' THEN 'no network'
  WHEN kind = 'missing' THEN 'Body not found.' WHEN kind = 'broken'
  THEN (SELECT n FROM unreadable) || ' unreadable records' ELSE 'not newer' END
  FROM tries LEFT JOIN applied ON tries.n = applied.n
  LEFT JOIN sizes ON applied.snapshot_ts = sizes.snapshot_ts
UNION ALL SELECT 'unreadable', 'records', CAST(n AS DOUBLE), {_NO_TIME}, {_NO_TEXT} FROM unreadable""",
}
