"""Validation rules as data (V1-V25) and the violations column they give.

A rule is a condition that is true where the rule is broken. All rules of a form are
evaluated in one projection; nothing here shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.cleansing import is_empty_sql
from tidemark.functions.sqltext import in_list, quoted
from tidemark.schemas import VIOLATION, VIOLATIONS

BLOCKS = "B"
WARNS = "w"

FAITHFUL = "faithful"
STRICT = "strict"

# Patterns of the form rules. A hyphen stands last in a class, where both the
# JVM's and DuckDB's patterns take it for itself; the sets are the ones the rules ask for.
NAME = r"\A[a-zA-Z'-]*\z"
PHONE = r"\A[0-9]{10}\z"
DIGIT = "[0-9]"
CAPITAL = "[A-Z]"
SMALL = "[a-z]"
SPECIAL = r"""['/~`!@#$%^&*()_\-+={}\[\]|;:"<>,.?\\]"""
SUBJECT = "[a-zA-Z' -]"
EMAIL = (
    r"\A[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+(\.[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+)*"
    r"@([A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+"
    r"[A-Za-z]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?\z"
)
EMAIL_MAX = 254
EMAIL_LOCAL_MAX = 64
PASSWORD_MIN_BYTES = 8
PHONE_MAX = 10
ADDRESS_MAX = 90

# The state placeholder and the listed states.
STATE_PLACEHOLDER = "Select an option"
STATES = ("Andra Pradesh", "Karnataka", "Kerala", "Tamil Nadu")

# Message per sign-up rule. V11, V24 and V25 are ours, the page shows none.
SIGNUP_MESSAGES = {
    "V1": "First name is mandatory",
    "V2": "Enter valid name",
    "V3": "Last name is mandatory",
    "V4": "Enter valid name",
    "V5": "Email is mandatory",
    "V6": "Invalid email format",
    "V7": "Address is mandatory",
    "V8": "Phone number is mandatory",
    "V9": "Invalid Phone number",
    "V10": "Please choose a state",
    "V11": "State is not one of the listed ones",
    "V12": "Please create a password",
    "V13": "Your password Must contain atleast  8 digits !",
    "V14": "Your password Must contain atleast  1 number !",
    "V15": "Your password Must contain atleast  1 Capital letter !",
    "V16": "Your password Must contain atleast  1 Small letter !",
    "V17": "Your password Must contain atleast  1 Special characters!",
    "V18": "Please create a password",
    "V19": "The passwords dont match",
    "V20": "This email or password is already in use! Please fill the details again.  ",
    "V24": "Longer than the form allows",
}

# Message per contact rule.
CONTACT_MESSAGES = {
    "V1": "Please enter the first name ",
    "V2": "Enter valid first name",
    "V3": "Please enter the Last name",
    "V4": "Enter valid last name",
    "V5": "Please enter email",
    "V6": "Invalid email format",
    "V21": "Please enter the subject ",
    "V22": "Enter valid Subject",
}

LOGIN_MESSAGES = {"V25": "Please fill out this field"}

# Outcome texts.
SIGNUP_DONE = "Signed up successfully"
SIGNUP_FAILED = "Failed to  sign up "
CONTACT_LEAD = "You must follow:\\n"


@dataclass(frozen=True)
class Rule:
    """``broken`` is a SQL condition over raw and cleansed columns."""

    rule: str
    field: str
    severity: str
    message: str
    broken: str


def valid_email(text: str) -> str:
    """Dot-atom address with a dotted domain whose last label starts with a letter.

    The lengths are tested first, so the pattern never meets a long text.
    """
    return (
        f"CASE WHEN length({text}) <= {EMAIL_MAX} AND "
        f"length(substring_index({text}, '@', 1)) <= {EMAIL_LOCAL_MAX} "
        f"THEN {text} RLIKE {quoted(EMAIL)} ELSE false END"
    )


def _lacks(text: str, pattern: str) -> str:
    return f"NOT {text} RLIKE {quoted(pattern)}"


def _unless_empty(raw: str, broken: str) -> str:
    return f"NOT {is_empty_sql(raw)} AND {broken}"


def signup_rules(
    raw: dict[str, str], clean: dict[str, str], secret_seen: str, mode: str = FAITHFUL
) -> list[Rule]:
    """Rules in message order, over the names of raw and cleansed columns.
    ``secret_seen`` is the password text V13-V17 look at."""
    strict = mode == STRICT
    state = raw["state"]
    unchosen = f"({state} IS NULL OR {state} IN {in_list(('', STATE_PLACEHOLDER))})"
    unlisted = f"NOT {unchosen} AND {state} NOT IN {in_list(STATES)}"
    secret = raw["spassword"]

    def secret_lacks(pattern: str) -> str:
        return _unless_empty(secret, _lacks(secret_seen, pattern))

    def name_lacks(field: str) -> str:
        return _unless_empty(raw[field], _lacks(clean[field], NAME))

    too_short = f"octet_length({secret_seen}) < {PASSWORD_MIN_BYTES}"
    differs = f"{clean['spassword']} <> {clean['conpassword']}"
    broken = [
        ("V1", "ftname", BLOCKS, is_empty_sql(raw["ftname"])),
        ("V2", "ftname", BLOCKS, name_lacks("ftname")),
        ("V3", "ltname", BLOCKS, is_empty_sql(raw["ltname"])),
        ("V4", "ltname", BLOCKS, name_lacks("ltname")),
        ("V5", "email", BLOCKS, is_empty_sql(raw["email"])),
        ("V6", "email", BLOCKS, _unless_empty(raw["email"], f"NOT {valid_email(clean['email'])}")),
        ("V7", "address", BLOCKS, is_empty_sql(raw["address"])),
        ("V24", "address", WARNS, f"length({raw['address']}) > {ADDRESS_MAX}"),
        ("V8", "Phonenumber", BLOCKS, is_empty_sql(raw["Phonenumber"])),
        (
            "V9",
            "Phonenumber",
            BLOCKS,
            _unless_empty(raw["Phonenumber"], _lacks(clean["Phonenumber"], PHONE)),
        ),
        ("V24", "Phonenumber", WARNS, f"length({raw['Phonenumber']}) > {PHONE_MAX}"),
        ("V10", "state", BLOCKS, unchosen),
        ("V11", "state", BLOCKS if strict else WARNS, unlisted),
        ("V12", "spassword", BLOCKS, is_empty_sql(secret)),
        ("V13", "spassword", BLOCKS, _unless_empty(secret, too_short)),
        ("V14", "spassword", BLOCKS, secret_lacks(DIGIT)),
        ("V15", "spassword", BLOCKS, secret_lacks(CAPITAL)),
        ("V16", "spassword", BLOCKS, secret_lacks(SMALL)),
        ("V17", "spassword", BLOCKS, secret_lacks(SPECIAL)),
        ("V18", "conpassword", BLOCKS if strict else WARNS, is_empty_sql(raw["conpassword"])),
        ("V19", "conpassword", BLOCKS, _unless_empty(raw["conpassword"], differs)),
    ]
    return [Rule(r, f, s, SIGNUP_MESSAGES[r], b) for r, f, s, b in broken]


def contact_rules(raw: dict[str, str], clean: dict[str, str]) -> list[Rule]:
    """The description is cleansed but never judged."""

    def lacks(field: str, pattern: str) -> str:
        return _unless_empty(raw[field], _lacks(clean[field], pattern))

    bad_mail = _unless_empty(raw["mailid"], f"NOT {valid_email(clean['mailid'])}")
    broken = [
        ("V1", "firstname", is_empty_sql(raw["firstname"])),
        ("V2", "firstname", lacks("firstname", NAME)),
        ("V3", "lastname", is_empty_sql(raw["lastname"])),
        ("V4", "lastname", lacks("lastname", NAME)),
        ("V5", "mailid", is_empty_sql(raw["mailid"])),
        ("V6", "mailid", bad_mail),
        ("V21", "subject", is_empty_sql(raw["subject"])),
        ("V22", "subject", lacks("subject", SUBJECT)),
    ]
    return [Rule(r, f, BLOCKS, CONTACT_MESSAGES[r], b) for r, f, b in broken]


def login_rules(raw: dict[str, str]) -> list[Rule]:
    """Fields the log-in page marks as required; they only warn."""
    return [
        Rule("V25", field, WARNS, LOGIN_MESSAGES["V25"], f"{name} IS NULL OR {name} = ''")
        for field, name in raw.items()
    ]


def _violation(rule: str, field: str, severity: str, message: str) -> str:
    names_values = zip(VIOLATION.names, (rule, field, severity, message), strict=True)
    pairs = ", ".join(f"'{name}', {quoted(value)}" for name, value in names_values)
    return f"named_struct({pairs})"


def violations(rules: list[Rule]) -> Column:
    """Array of the broken rules, in rule order."""
    found = ", ".join(
        f"CASE WHEN {r.broken} THEN {_violation(r.rule, r.field, r.severity, r.message)} END"
        for r in rules
    )
    return F.expr(f"filter(array({found}), v -> v IS NOT NULL)").cast(VIOLATIONS)


def with_taken(known: str) -> Column:
    """The violations, with V20 added where a record is known already."""
    taken = _violation("V20", "email", BLOCKS, SIGNUP_MESSAGES["V20"])
    return F.expr(
        f"CASE WHEN {known} THEN concat(violations, array({taken})) ELSE violations END"
    )


def passes(rules: list[Rule]) -> Column:
    """No blocking rule is broken. Reads the rules themselves, so that a filter on it
    needs no violations array."""
    broken = " OR ".join(f"coalesce({r.broken}, false)" for r in rules if r.severity == BLOCKS)
    return F.expr(f"NOT ({broken})")


def message_text(found: str, fields: tuple[str, ...] = (), end: str = "") -> str:
    """Messages in order, each followed by ``end``; of some fields only if named."""
    if fields:
        found = f"filter({found}, v -> v.field IN {in_list(fields)})"
    return f"array_join(transform({found}, v -> concat(v.message, {quoted(end)})), '')"


def rule_text(found: str = "violations") -> Column:
    """Broken rules as ``V2:ftname,V9:Phonenumber``, for reports."""
    return F.expr(f"array_join(transform({found}, v -> concat(v.rule, ':', v.field)), ',')")
