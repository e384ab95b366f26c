"""Form intake: cleanse, judge by rules, check for duplicates, split by outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rules as r
from tidemark.functions.cleansing import (
    clean_input_sql,
    clean_or_blank_sql,
    clean_unescaped_sql,
    digest,
    lower_email_sql,
)
from tidemark.functions.sqltext import in_list, quoted
from tidemark.operators.identity import EXACTLY_ONE, is_duplicate_sql, with_match_counts
from tidemark.schemas import CONTACT_FIELDS, SIGNUP_FIELDS

PASSWORD_FIELDS = ("spassword", "conpassword")


def _raw(fields: tuple[str, ...]) -> dict[str, str]:
    return {name: f"__raw_{name}" for name in fields}


def _clean(fields: tuple[str, ...]) -> dict[str, str]:
    return {name: name for name in fields}


def _beside_raw(submissions: DataFrame, cleansed: dict[str, str]) -> DataFrame:
    """Cleansed fields under their own names, with the raw ones kept beside them.

    The one-row ``inline`` keeps cleansing from being repeated: a later filter on the
    outcome would else be pushed below it with a copy of every cleansing it looks at.
    """
    others = [c for c in submissions.columns if c not in cleansed]
    raw = [f"{name} AS __raw_{name}" for name in cleansed]
    row = ", ".join(f"'{name}', {text}" for name, text in cleansed.items())
    return submissions.selectExpr(*others, *raw, f"inline(array(named_struct({row})))")


def judge_signups(
    submissions: DataFrame,
    members: DataFrame | None = None,
    mode: str = r.FAITHFUL,
    match_rule: str = EXACTLY_ONE,
    escape_single_quote: bool = True,
) -> DataFrame:
    """Sign-up records with cleansed fields, ``violations`` and ``accepted``.

    The password texts leave only as ``secret_digest``. Rules see text after escaping;
    ``strict`` mode judges the password before it, and blocks what else only warns.
    The duplicate check runs for every record, broken rules or not.
    """
    cleansed = {name: clean_or_blank_sql(name, escape_single_quote) for name in SIGNUP_FIELDS}
    cleansed["email"] = lower_email_sql(cleansed["email"])
    # A state is stored as given, and only when it was chosen.
    cleansed["state"] = (
        f"CASE WHEN state IS NULL OR state = {quoted(r.STATE_PLACEHOLDER)} THEN '' ELSE state END"
    )
    raw = _raw(SIGNUP_FIELDS)
    secret_seen = "spassword"
    if mode == r.STRICT:
        secret_seen = clean_unescaped_sql(raw["spassword"])
    rules = r.signup_rules(raw, _clean(SIGNUP_FIELDS), secret_seen, mode)
    judged = (
        _beside_raw(submissions, cleansed)
        .withColumns(
            {
                "violations": r.violations(rules),
                "accepted": r.passes(rules),
                "secret_digest": digest("conpassword"),
            }
        )
        .drop(*raw.values(), *PASSWORD_FIELDS)
    )
    return judged if members is None else mark_known(judged, members, match_rule)


def mark_known(
    judged: DataFrame, members: DataFrame, match_rule: str = EXACTLY_ONE
) -> DataFrame:
    """Judged sign-ups with the duplicate rule added."""
    return mark_counted(with_match_counts(judged, members), match_rule)


def mark_counted(counted: DataFrame, match_rule: str = EXACTLY_ONE) -> DataFrame:
    """The same from sign-ups that have the number of members they meet."""
    known = is_duplicate_sql(match_rule)
    return counted.withColumns(
        {
            "violations": r.with_taken(known),
            "accepted": F.expr(f"accepted AND NOT {known}"),
        }
    ).drop("n_matches")


def judge_contacts(submissions: DataFrame, escape_single_quote: bool = True) -> DataFrame:
    """Contact records likewise (V1-V6, V21-V23); email case is kept."""
    cleansed = {name: clean_or_blank_sql(name, escape_single_quote) for name in CONTACT_FIELDS}
    # The description is cleansed whatever it holds, so '0' stays '0'.
    cleansed["description"] = (
        f"coalesce({clean_input_sql('description', escape_single_quote)}, '')"
    )
    raw = _raw(CONTACT_FIELDS)
    rules = r.contact_rules(raw, _clean(CONTACT_FIELDS))
    return (
        _beside_raw(submissions, cleansed)
        .withColumns({"violations": r.violations(rules), "accepted": r.passes(rules)})
        .drop(*raw.values())
    )


def judge_logins(attempts: DataFrame, escape_single_quote: bool = True) -> DataFrame:
    """Log-in attempts: warnings for blank fields, cleansed email, secret as a digest."""
    fields = ("email", "pass")
    clean = {n: f"coalesce({clean_input_sql(n, escape_single_quote)}, '')" for n in fields}
    return attempts.select(
        *[c for c in attempts.columns if c not in fields],
        r.violations(r.login_rules(_clean(fields))).alias("violations"),
        F.expr(clean["email"]).alias("email"),
        digest(clean["pass"]).alias("pass_digest"),
    )


# V20 is told on its own, and V11 and V24 are notes of ours; no field text shows them.
_UNSHOWN = ("V11", "V20", "V24")


def signup_texts(judged: DataFrame, *keep: str) -> DataFrame:
    """The eight per-field message texts and the outcome."""
    shown = judged.withColumn(
        "violations", F.expr(f"filter(violations, v -> v.rule NOT IN {in_list(_UNSHOWN)})")
    )

    def text(field: str, end: str = "") -> str:
        return r.message_text("violations", (field,), end)

    # Password shortcomings end in a line break each, a missing password does not.
    password = (
        "CASE WHEN exists(violations, v -> v.rule = 'V12') "
        f"THEN {text('spassword')} ELSE {text('spassword', '<br>')} END"
    )
    done, failed = quoted(r.SIGNUP_DONE), quoted(r.SIGNUP_FAILED)
    return shown.selectExpr(
        *keep,
        f"{text('ftname')} AS first_name_text",
        f"{text('ltname')} AS last_name_text",
        f"{text('email')} AS email_text",
        f"{text('Phonenumber')} AS phone_text",
        f"{text('address')} AS address_text",
        f"{password} AS password_text",
        f"{text('conpassword')} AS confirm_text",
        f"{text('state')} AS state_text",
        f"CASE WHEN accepted THEN {done} ELSE {failed} END AS outcome",
    )


def contact_text() -> Column:
    """All messages, each ended by a literal backslash-n, after a lead; null if accepted."""
    text = r.message_text("violations", end="\\n")
    lead = quoted(r.CONTACT_LEAD)
    return F.expr(f"CASE WHEN NOT accepted THEN concat({lead}, {text}) END").alias("message")
