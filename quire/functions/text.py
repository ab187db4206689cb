"""Text expressions: cleaning, licences, languages, names, titles, tokens."""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Characters that count as a plain apostrophe (fixed values).
SINGLE_QUOTES = "`‘’‛⸂⸃⸌⸍⸜⸝"
#: ISO 639-2/B and MARC codes to ISO 639-1 (fixed values).
LANGUAGES = {
    "eng": "en", "fre": "fr", "ger": "de", "spa": "es", "ita": "it", "por": "pt", "rus": "ru", "jpn": "ja", "chi": "zh", "kor": "ko",
    "dut": "nl", "pol": "pl", "swe": "sv", "dan": "da", "nor": "no", "fin": "fi", "ara": "ar", "heb": "he", "tur": "tr", "cze": "cs",
    "hun": "hu", "rum": "ro", "gre": "el", "ukr": "uk", "hrv": "hr", "slv": "sl", "bul": "bg", "cat": "ca", "vie": "vi", "ind": "id",
    "per": "fa", "hin": "hi", "lat": "la", "wel": "cy", "geo": "ka", "afr": "af", "slo": "sk", "lit": "lt", "lav": "lv", "est": "et",
    "alb": "sq", "ice": "is", "mac": "mk", "ser": "sr", "bos": "bs", "mon": "mn", "ben": "bn", "tam": "ta", "glg": "gl", "scr": "hr", "scc": "sr",
}
#: Licence addresses without scheme to slugs (fixed values).
LICENCES = {
    "//creativecommons.org/publicdomain/mark/1.0": "CC-0",
    "//creativecommons.org/publicdomain/mark/1.0/deed.de": "CC-0",
    "//creativecommons.org/publicdomain/zero/1.0": "CC-0",
    "//creativecommons.org/share-your-work/public-domain/cc0": "CC-0",
    "//creativecommons.org/licenses/by/2.0": "CC-BY",
    "//creativecommons.org/licenses/by/3.0": "CC-BY",
    "//creativecommons.org/licenses/by/4.0": "CC-BY",
    "//creativecommons.org/licenses/by-sa/3.0": "CC-BY-SA",
    "//creativecommons.org/licenses/by-sa/4.0": "CC-BY-SA",
    "//creativecommons.org/licenses/by-nd/3.0": "CC-BY-ND",
    "//creativecommons.org/licenses/by-nd/4.0": "CC-BY-ND",
    "//creativecommons.org/licenses/by-nc/3.0": "CC-BY-NC",
    "//creativecommons.org/licenses/by-nc/4.0": "CC-BY-NC",
    "//creativecommons.org/licenses/by-nc-sa/3.0": "CC-BY-NC-SA",
    "//creativecommons.org/licenses/by-nc-sa/4.0": "CC-BY-NC-SA",
    "//creativecommons.org/licenses/by-nc-nd/3.0": "CC-BY-NC-ND",
    "//creativecommons.org/licenses/by-nc-nd/4.0": "CC-BY-NC-ND",
    "//spdx.org/licenses/cc0-1.0.json": "CC-0",
    "//spdx.org/licenses/cc-by-1.0.json": "CC-BY",
    "//spdx.org/licenses/cc-by-4.0.json": "CC-BY",
    "//spdx.org/licenses/cc-by-nc-4.0.json": "CC-BY-NC",
    "//spdx.org/licenses/cc-by-sa-3.0.json": "CC-BY-SA",
    "//spdx.org/licenses/cc-by-sa-4.0.json": "CC-BY-SA",
    "//spdx.org/licenses/mit.json": "MIT",
    "//spdx.org/licenses/ogl-canada-2.0.json": "OGL-Canada",
    "//www.elsevier.com/open-access/userlicense/1.0": "ELSEVIER-USER-1.0",
    "//www.elsevier.com/tdm/userlicense/1.0": "ELSEVIER-USER-1.0",
    "//archaeologydataservice.ac.uk/advice/termsofuseandaccess.xhtml": "ADS-UK",
    "//archaeologydataservice.ac.uk/advice/termsofuseandaccess": "ADS-UK",
    "//homepage.data-planet.com/terms-use": "SAGE-DATA-PLANET",
    "//publikationen.bibliothek.kit.edu/kitopen-lizenz": "KIT-OPEN",
    "//pubs.acs.org/page/policy/authorchoice_ccby_termsofuse.html": "CC-BY",
    "//pubs.acs.org/page/policy/authorchoice_termsofuse.html": "ACS-CHOICE",
    "//www.ametsoc.org/pubsreuselicenses": "AMETSOC",
    "//www.apa.org/pubs/journals/resources/open-access.aspx": "APA",
    "//www.biologists.com/user-licence-1-1": "BIOLOGISTS-USER",
    "//www.gnu.org/licenses/gpl-3.0.en.html": "GPLv3",
    "//www.gnu.org/licenses/old-licenses/gpl-2.0.en.html": "GPLv2",
    "//arxiv.org/licenses/nonexclusive-distrib/1.0": "ARXIV-1.0",
}


def lookup(x: Column, table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for kv in table.items() for v in kv])[x]


def clean_string(x: Column) -> Column:
    """Quotes and ellipses folded to ASCII; two apostrophes or two commas are a quotation mark."""
    x = F.translate(x, SINGLE_QUOTES, "'" * len(SINGLE_QUOTES))
    x = F.translate(F.replace(x, F.lit("…"), F.lit("...")), "„“”", '"""')
    return F.replace(F.replace(x, F.lit("''"), F.lit('"')), F.lit(",,"), F.lit('"'))


def language(x: Column) -> Column:
    x = F.lower(F.trim(x))
    return F.when(F.length(x) == 2, x).when(F.length(x) == 3, lookup(x, LANGUAGES)).when(F.substring(x, 3, 1) == "-", F.substring(x, 1, 2))


def licence_slug(url: Column) -> Column:
    u = F.lower(url)
    host, path = F.coalesce(F.try_parse_url(u, F.lit("AUTHORITY")), F.lit("")), F.regexp_replace(F.coalesce(F.try_parse_url(u, F.lit("PATH")), F.lit("")), "/$", "")
    path = F.when(host == "creativecommons.org", F.regexp_replace(F.regexp_replace(path, "/legalcode$", ""), "/uk$", "")).otherwise(path)
    return lookup(F.concat(F.lit("//"), host, path), LICENCES)


@F.pandas_udf(StringType())
def detag(values: pd.Series) -> pd.Series:
    """Rendered text of HTML."""
    from html.parser import HTMLParser

    class Text(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.parts: list[str] = []

        def handle_data(self, data):
            self.parts.append(data)

    def one(x):
        if x is None or "<" not in x and "&" not in x:
            return x
        p = Text()
        p.feed(x)
        p.close()
        return "".join(p.parts)

    return values.map(one)


def strip_tags(x: Column) -> Column:
    """Markup removed by pattern, for short inner XML."""
    return F.trim(F.regexp_replace(x, "<[^>]+>", ""))


def is_ascii(x: Column) -> Column:
    return ~x.rlike(r"[^\x00-\x7f]")


def pipeline(*steps):
    """Composition of Column functions, first step first."""
    return lambda x: reduce(lambda value, step: step(value), steps, x)


title_key = pipeline(F.lower, lambda x: F.regexp_replace(x, r"[^\p{L}]", ""))


def one_line(x: Column) -> Column:
    return F.translate(x, "\n\t", "  ")


def split_name(name: Column) -> Column:
    """struct(given, surname): `Surname, Given` or the last token as surname."""
    parts = F.split(F.trim(name), r"\s+")
    comma = F.contains(name, F.lit(","))
    given = F.when(comma, F.trim(F.substring_index(name, ",", -1))).otherwise(F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), " "))
    surname = F.when(comma, F.trim(F.substring_index(name, ",", 1))).otherwise(F.element_at(parts, -1))
    return F.struct(F.nullif(given, F.lit("")).alias("given"), F.nullif(surname, F.lit("")).alias("surname"))


#: Words of names that are no persons' (fixed values).
CORPORATE = (
    "archive", "collection", "coordinator", "department", "germany", "international", "national", "netherlands", "office", "organisation", "organization", "service", "services", "united states", "university", "verein", "volkshochschule",
)


def index_to_display(name: Column) -> Column:
    """`Surname, Given` as `Given Surname`; names of bodies, and those with brackets, asterisks or several commas, stay."""
    stays = ~F.contains(name, F.lit(",")) | name.rlike(r"[()*]|,.*,") | F.lower(name).rlike("|".join(CORPORATE))
    return F.when(stays, name).otherwise(F.concat_ws(" ", F.trim(F.substring_index(name, ",", -1)), F.trim(F.substring_index(name, ",", 1))))


#: Marks at a file's start that name its encoding (fixed values).
MARKS = ((b"\xef\xbb\xbf", "utf-8"), (b"\xfe\xff", "utf-16-be"), (b"\xff\xfe", "utf-16-le"))
#: Names that pages give, and what they are read as (fixed values).
READ_AS = {"iso-8859-1": "cp1252", "latin1": "cp1252", "latin-1": "cp1252", "iso8859-1": "cp1252", "us-ascii": "cp1252", "ascii": "cp1252", "windows-1252": "cp1252", "iso-8859-9": "cp1254", "gb2312": "gb18030", "gbk": "gb18030", "x-sjis": "shift_jis", "utf-16": "utf-16-le"}
PRESCAN = 1024  # bytes of a page in which it may name its own character set


def charset_of(body: bytes, header: str | None) -> tuple[str, int]:
    """(codec, length of the mark to cut): by the mark, the header's charset, what the page's first bytes say, UTF-8 if it reads as that, else windows-1252."""
    import codecs
    import re

    for mark, name in MARKS:
        if body.startswith(mark):
            return name, len(mark)
    found = re.search(r"charset\s*=\s*[\"']?([^\s\"';,]+)", header or "", re.I) or re.fullmatch(r"\s*([\w.:-]+)\s*()", header or "")
    inside = re.search(rb"<meta[^>]+charset\s*=\s*[\"']?\s*([\w.:-]+)", body[:PRESCAN], re.I)
    for name in (found and found[1], inside and inside[1].decode("latin-1")):
        name = READ_AS.get((name or "").lower(), name)
        if name and inside is not None and found is None and name.lower().startswith("utf-16"):
            name = "utf-8"  # a page that can be read so far is not in UTF-16
        try:
            if name:
                codecs.lookup(name)
                return name, 0
        except LookupError:
            continue
    try:
        body.decode("utf-8")
    except UnicodeDecodeError:
        return "cp1252", 0
    return "utf-8", 0


@F.pandas_udf(StringType())
def decoded(body: pd.Series, header: pd.Series) -> pd.Series:
    """The text of a page's bytes, by its mark, the content type's charset (or a bare name), its own words, or what its bytes look like; NULL of NULL."""

    def one(data, head):
        if data is None:
            return None
        data = bytes(data)
        name, cut = charset_of(data, head if isinstance(head, str) else None)
        return data[cut:].decode(name, "replace")

    return pd.Series([one(b, h) for b, h in zip(body, header, strict=True)], dtype=object)


def display_name(creator_id: Column, creator_name: Column, raw: Column, given: Column, surname: Column) -> Column:
    """A known creator's name, even if empty; else the raw name, else given and surname."""
    joined = F.nullif(F.trim(F.concat_ws(" ", given, surname)), F.lit(""))
    return F.when(creator_id.isNotNull(), F.coalesce(creator_name, F.lit(""))).otherwise(F.coalesce(F.nullif(raw, F.lit("")), joined))


#: Words that say nothing about a title (fixed values).
STOP_WORDS = (
    "with", "from", "this", "that", "into", "their", "what", "when", "your", "have", "been", "than", "they", "them", "were", "where", "which", "would", "could", "should", "about",
)


def title_tokens(x: Column, shortest: int = 4, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    words = F.array_distinct(F.filter(F.split(F.lower(x), r"[^\p{L}\p{Nd}]+"), lambda t: F.octet_length(t) >= shortest))
    return F.array_except(words, F.array(*map(F.lit, stop)))


def tokens_overlap(a: Column, b: Column) -> Column:
    """At least 40 % of a's tokens are b's."""
    return (F.size(a) > 0) & (F.size(F.array_intersect(a, b)) * 5 >= F.size(a) * 2)


def split_creators(x: Column) -> Column:
    return F.filter(F.transform(F.split(x, ";"), lambda t: F.trim(t)), lambda t: t != "")


def weblinks(x: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(x, F.lit(r"(https?://[^\s\"'<>)]+)"), 1)))


def small_int(x: Column) -> Column:
    n = F.expr("1") * F.coalesce(F.trim(x).try_cast("int"), F.lit(0))
    return F.when(n.between(0, 30000), n).otherwise(0)


def citation_key(key: Column, index: Column) -> Column:
    """A reference's key without the parts that name the citing work; without a key the reference's number."""
    x = F.regexp_replace(F.regexp_replace(key, r"^\s+|\s+$", ""), "^[/_]", "")
    x = F.regexp_replace(x, r"^10\.(?=.*SICI).*-", "")
    x = F.regexp_replace(x, r"^10\..*_", "")
    for mark in ("#", "_"):
        x = F.regexp_replace(x, f"^(?=.{{11}}).*{mark}", "")
    return F.when(F.coalesce(key, F.lit("")) == "", index.cast("string")).otherwise(x)


def size_label(n: Column) -> Column:
    """Under a thousand bytes, or unknown: empty."""
    return F.when(n >= 1000000, F.format_string("%.1f MB", n / 1000000.0)).when(n >= 1000, F.format_string("%d kB", (n / 1000).cast("long"))).otherwise("")


#: Headings before abstracts, cut one after another, blanks included (fixed values).
ABSTRACT_HEADINGS = (
    "Abstract No Abstract ", "Publisher Summary ", "Abstract ", "ABSTRACT ", "Summary ", "Background: ", "Background ", "N/a.", "No abstract.", "Introduction: ", "ACKNOWLEDGEMENTS ", "a b s t r a c t ",
)


def trim_abstract(x: Column) -> Column:
    """An abstract without headings; NULL where one word or less is left."""
    body = x
    for p in ABSTRACT_HEADINGS:
        body = F.regexp_replace(body, "^" + re.escape(p), "")
    return F.when(F.size(F.filter(F.split(body, r"\s+"), lambda w: w != "")) > 1, body)


def first_abstracts(abstracts: Column) -> Column:
    """Of an array of (language, content), the first of each language that has a body: array of (body, language), in order."""
    some = F.filter(F.transform(abstracts, lambda a: F.struct(trim_abstract(clean_string(a["content"])).alias("body"), a["language"].alias("language"))), lambda a: a["body"].isNotNull())
    langs = F.transform(some, lambda a: F.coalesce(a["language"], F.lit("")))
    return F.filter(some, lambda a, i: F.array_position(langs, F.coalesce(a["language"], F.lit(""))) == i + 1)


def highlight(x: Column, term: str, around: int = 75) -> Column:
    """A fragment of 2 * around characters about the first hit."""
    at = F.instr(F.lower(x), term.lower())
    return F.when(at > 0, F.substr(x, F.greatest(at - around, F.lit(1)), F.lit(2 * around)))
