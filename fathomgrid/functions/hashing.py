"""Keyed hashes and stand-in values as column expressions; blank values pass unchanged, null stays null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Salts that make hashes comparable with earlier runs.
STORE_SALT = "pii-store:"
ROSTER_SALT = "pii-mask-fallback-v1:"
GITHUB_SALT = "pii-mask-github-v1:"
JIRA_SALT = "pii-mask-jira-v1:"
CONFLUENCE_SALT = "pii-mask-confluence-v1:"


def salted(value: Column, salt: str, length: int) -> Column:
    """First hexadecimal digits of the salted SHA-256."""
    return F.substring(F.sha2(F.concat(F.lit(salt), value), 256), 1, length)


def _kept_blank(value: Column, masked: Column) -> Column:
    return F.when(value == "", value).when(value.isNotNull(), masked)


def login(value: Column, salt: str = GITHUB_SALT) -> Column:
    return _kept_blank(value, F.concat(F.lit("user-"), salted(value, salt, 10)))


def person(value: Column, salt: str = GITHUB_SALT) -> Column:
    return _kept_blank(value, F.concat(F.lit("User "), salted(value, salt, 8)))


def account(value: Column, salt: str = JIRA_SALT) -> Column:
    return _kept_blank(value, F.concat(F.lit("acct-"), salted(value, salt, 16)))


def text(value: Column, salt: str = GITHUB_SALT) -> Column:
    return _kept_blank(value, salted(value, salt, 24))


def local_part(email: Column) -> Column:
    """What stands before the last @; the whole value where there is none."""
    return F.regexp_replace(email, "@[^@]*$", "")


def domain_part(email: Column) -> Column:
    """What stands after the last @; null where there is none."""
    return F.when(F.contains(email, F.lit("@")), F.element_at(F.split(email, "@"), -1))


def email(value: Column, domain: Column, salt: str = GITHUB_SALT) -> Column:
    """Hashed local part at another domain; a value without @ becomes twelve digits of its hash."""
    whole = F.concat(salted(local_part(value), salt, 8), F.lit("@"), domain)
    return _kept_blank(value, F.when(F.contains(value, F.lit("@")), whole).otherwise(salted(value, salt, 12)))


def profile_url(value: Column, salt: str = GITHUB_SALT) -> Column:
    """The first path segment of a profile address hashed, the rest kept."""
    pattern = r"^(https?://github\.com/)([^/]+)(.*)"
    user = F.regexp_extract(value, pattern, 2)
    return F.when(user != "", F.concat(F.regexp_extract(value, pattern, 1), login(user, salt), F.regexp_extract(value, pattern, 3))).otherwise(value)


def _h(value: Column, length: int) -> Column:
    return salted(value, STORE_SALT, length)


def _digits(value: Column, length: int) -> Column:
    return F.translate(_h(value, length), "abcdef", "012345")


def _number(value: Column, at: int) -> Column:
    return F.conv(F.substring(_h(value, 8), at, 4), 16, 10).cast("int")


def stand_in(kind: str, value: Column) -> Column:
    """A stand-in for a value of a kind: a pure function of kind and value, so equal values stay equal everywhere."""
    grouped = F.concat_ws(" ", *[F.substring(_digits(value, 12), i, 4) for i in (1, 5, 9)])
    address = [F.conv(F.substring(_h(value, 4), i, 2), 16, 10) for i in (1, 3)]
    made = {
        "PHONE_NUMBER": F.concat(F.lit("[PHONE-"), _h(value, 6), F.lit("]")),
        "IP_ADDRESS": F.concat(F.lit("10.0."), address[0], F.lit("."), address[1]),
        "CREDIT_CARD": F.lit("[REDACTED]"),
        "IBAN_CODE": F.lit("[REDACTED-IBAN]"),
        "US_SSN": F.lit("[REDACTED-SSN]"),
        "NRP": F.lit("[REDACTED-NRP]"),
        "MEDICAL_LICENSE": F.concat(F.lit("[MEDICAL-"), _h(value, 6), F.lit("]")),
        "IN_PAN": F.concat(F.lit("ZZZZZ"), F.upper(_h(value, 4)), F.lit("Z")),
        "IN_AADHAAR": grouped,
        "IN_UPI_ID": F.concat(F.lit("user."), _h(value, 8), F.lit("@redacted")),
        "IN_IFSC": F.concat(F.lit("XXXX0"), F.upper(_h(value, 6))),
        "IN_BANK_ACCOUNT": _digits(value, 14),
        "IN_GST": F.concat(F.lit("00ZZZZZ0000Z1Z"), F.upper(_h(value, 1))),
        "GEO_COORDINATE": F.concat((_number(value, 1) % 180 - 90).cast("string"), F.lit(".0000,"), (_number(value, 5) % 360 - 180).cast("string"), F.lit(".0000")),
        "JIRA_ACCOUNT_ID": F.concat(F.lit("mask-"), _h(value, 8)),
    }
    return made.get(kind, F.concat(F.lit(f"[{kind}-"), _h(value, 8), F.lit("]")))


# Parts of invented names; a hash picks one of each.
_GIVEN = "Ada Bela Caro Dorn Edda Finn Gert Hale Iris Jory Kaja Lars Mona Nils Orla Pia Quin Rhea Sven Tove Ulla Vito Wren Xara Yann Zora Abel Birk Cleo Dara Esra Fritz".split()
_FAMILY_A = "Ash Birch Cold Dale East Fern Glen High Iron Jade Kings Lake Mill North Oak Penn Quill Rose Stone Thorn".split()
_FAMILY_B = "berg bury croft dale field ford gate ham hurst land ley mont mere more ridge shaw stead ton wick wood".split()


def invented_name(value: Column, salt: str = STORE_SALT) -> Column:
    """An invented given and family name chosen by the hash of the lower-case value."""
    h = F.sha2(F.concat(F.lit(salt), F.lower(value)), 256)

    def pick(words: list[str], at: int) -> Column:
        number = F.conv(F.substring(h, at, 8), 16, 10).cast("long")
        return F.element_at(F.array(*map(F.lit, words)), (number % len(words) + 1).cast("int"))

    return _kept_blank(value, F.concat(pick(_GIVEN, 1), F.lit(" "), pick(_FAMILY_A, 9), pick(_FAMILY_B, 17)))
