"""Contact fields, addresses on the web, agents and person names."""

from pyspark.sql import functions as F

from ledgerloom.functions import fixed
from ledgerloom.functions.text import _col

CONTACT_SCHEMA = "array<struct<type:string,value:string,source:string>>"
NAME_RECORD_SCHEMA = "array<struct<name:string,status:string,expiration_date:string>>"


def classify_contact(value):
    """One free-text field as a struct of email, url, fax and phone.

    An e-mail address wins over a web address, both win over a telephone; a
    fax number is told by its label.
    """
    value = _col(value)
    email = F.when(value.rlike(fixed.EMAIL_PATTERN), value)
    url = F.when(value.rlike(fixed.URL_PATTERN) & email.isNull(), value)
    fax = F.when(value.rlike(fixed.FAX_PATTERN), value)
    phone = F.when(
        email.isNull() & url.isNull() & fax.isNull()
        & value.rlike(r"\d")
        & ~value.rlike("[a-zA-Z]")
        & (F.length(value) >= 3),
        value,
    )
    return F.struct(
        F.regexp_replace(email, r"(?i)\(at\)", "@").alias("email"),
        url.alias("url"),
        F.regexp_replace(fax, r"(FAX|fax)\s?", "").alias("fax"),
        phone.alias("phone"),
    )


def domain_of(url):
    """Host of a web address without a leading ``www.`` or ``m.``."""
    return F.regexp_extract(_col(url), r"https?://(www\.|m\.)?([^/]+)", 2)


def classify_url(url):
    """A struct of domain, facebook, twitter, linkedin and other website."""
    url = _col(url)
    domain = domain_of(url)
    kinds = {
        "facebook_url": domain.contains("facebook"),
        "twitter_url": domain.contains("twitter") | (domain == "x.com"),
        "linkedin_url": domain.contains("linkedin"),
    }
    social = kinds["facebook_url"] | kinds["twitter_url"] | kinds["linkedin_url"]
    return F.struct(
        domain.alias("domain"),
        *[F.when(test, url).alias(name) for name, test in kinds.items()],
        F.when(~social, url).alias("website"),
    )


def contacts_of_type(parsed, kind, excluded_source="backlinks"):
    """Values of one contact type, joined, without one source."""
    wanted = F.filter(
        _col(parsed), lambda x: (x["type"] == kind) & (x["source"] != excluded_source)
    )
    return F.concat_ws(", ", F.transform(wanted, lambda x: x["value"]))


def merge_bracket_lists(first, second):
    """Two bracketed lists as one array; the text ``null`` is no list."""
    first, second = (F.regexp_replace(_col(c), r"[\[\]]", "") for c in (first, second))
    both = (first != "null") & (second != "null")
    return F.split(
        F.when(both, F.concat(first, F.lit(" "), second)).otherwise(F.coalesce(first, second)), ","
    )


def is_person(name):
    """False for names with an organisation word, a digit or a symbol."""
    plain = F.regexp_replace(F.upper(_col(name)), "[.,]", "")
    organisation = (
        plain.rlike(r"\b(?:" + "|".join(fixed.ORGANISATION_WORDS) + r")\b")
        | plain.rlike(r"[0-9&|#]")
    )
    return ~F.coalesce(organisation, F.lit(False))


def agent_from_list(value):
    """Agent name and address from a list printed as text."""
    value = _col(value)
    second = F.regexp_extract(value, r"', '([^']+)", 1)
    name = F.when(second.rlike(r"^\d|SUIT|BOX"), F.regexp_extract(value, r"\['([^']+)'", 1))
    rest = F.regexp_extract(value, r"', '([^']+(?:', '[^']+)*)'", 1)
    return F.struct(
        F.when(~name.rlike(r"(?i)(ST\.|STREET)$"), name).alias("agent_name"),
        F.regexp_replace(rest, "', '", ", ").alias("agent_address"),
    )


def printed_list_as_text(value):
    """A printed list without quotes and brackets."""
    return F.regexp_replace(_col(value), r"['\[\]]", "")
