"""Upstream records to releases: DataFrames of parsed records in, one release schema out.

Every converter keeps all rows and gives a `skip_reason`; `accepted` drops those that have one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import dates, identifiers as ids, text
from quire.operators.search import first_reason

CONTRIB = "struct<raw_name:string,given_name:string,surname:string,role:string,raw_affiliation:string,position:int,extra:map<string,string>>"
RELEASE = (
    "id string, source string, title string, subtitle string, original_title string, release_type string, release_stage string, release_date date, release_year int, "
    "volume string, issue string, pages string, publisher string, language string, license_slug string, extids map<string,string>, "
    f"contribs array<{CONTRIB}>, abstracts array<struct<sha1:string,mimetype:string,language:string,content:string>>, refs array<struct<`index`:int,key:string,year:int,container_name:string,"
    "locator:string,title:string,extra:map<string,string>>>, version string, extra string, withdrawn_status string, skip_reason string"
)
#: Crossref types to release types (fixed values).
CROSSREF_TYPES = {
    "book": "book", "book-chapter": "chapter", "book-part": "chapter", "book-section": "chapter", "component": "component", "dataset": "dataset",
    "dissertation": "thesis", "edited-book": "book", "journal-article": "article-journal", "monograph": "book", "peer-review": "peer_review",
    "posted-content": "post", "proceedings-article": "paper-conference", "reference-book": "book", "reference-entry": "entry", "report": "report",
    "report-component": "component", "standard": "standard",
}
CROSSREF_IGNORED = ("", "database", "journal", "proceedings", "standard-series", "report-series", "book-series", "book-set", "book-track", "proceedings-series", "peer-review")
#: Crossref types that are published by their kind (fixed values).
CROSSREF_PUBLISHED = ("journal-article", "conference-proceedings", "book", "dissertation", "book-chapter")
CONTAINER_TYPES = {"article-journal": "journal", "paper-conference": "conference", "book": "book-series"}
#: Type vocabularies in order of precedence (fixed values).
DATACITE_TYPES = {
    "citeproc": {x: x for x in (
        "article", "article-journal", "article-magazine", "article-newspaper", "bill", "book", "broadcast", "chapter", "dataset", "entry-dictionary",
        "entry-encyclopedia", "entry", "figure", "graphic", "interview", "legal_case", "legislation", "manuscript", "map", "motion_picture", "musical_score",
        "pamphlet", "paper-conference", "patent", "personal_communication", "post", "post-weblog", "report", "review-book", "review", "song", "speech",
        "thesis", "treaty", "webpage")},
    "ris": {"THES": "thesis", "SOUND": "song", "CHAP": "chapter", "FIGURE": "figure", "RPRT": "report", "JOUR": "article-journal", "MPCT": "motion_picture", "GEN": "article-journal", "BOOK": "book", "DATA": "dataset", "COMP": "software"},
    "schemaOrg": {"Dataset": "dataset", "Book": "book", "ScholarlyArticle": "article-journal", "ImageObject": "graphic", "SoftwareSourceCode": "software", "Chapter": "chapter", "Thesis": "thesis", "PublicationIssue": "article"},
    "bibtex": {"phdthesis": "thesis", "inbook": "chapter", "article": "article-journal", "book": "book"},
    "resourceTypeGeneral": {"Image": "graphic", "Dataset": "dataset", "Software": "software"},
}
#: Publication types to release types (fixed values).
PUBMED_TYPES = {
    "Journal Article": "article-journal", "Classical Article": "article-journal", "Historical Article": "article-journal", "Introductory Journal Article": "article-journal",
    "Newspaper Article": "article-newspaper", "Editorial": "editorial", "Letter": "letter", "Dataset": "dataset", "Technical Report": "report", "Interview": "interview",
    "Lecture": "speech", "Address": "speech", "Autobiography": "book", "Biography": "book", "Legal Case": "legal_case", "Legislation": "legislation",
}
#: Markers of missing values, and tokens of spam titles (fixed values).
UNKNOWN = ("(:unac)", "(:unal)", "(:unap)", "(:unas)", "(:unav)", "(:unkn)", "(:none)", "(:null)", "(:tba)", "(:etal)", "na", "nn", "n.a.", "[s.n.]", "unknown")
SPAM = ("full", "movies", "movie", "watch", "streaming", "online", "free", "hd", "download", "english", "subtitle", "bluray")


def is_unknown(x: Column) -> Column:
    return F.lower(F.trim(x)).isin(*UNKNOWN)


def is_spam(title: Column) -> Column:
    low = F.lower(title)
    return sum((F.contains(low, F.lit(t)).cast("int") for t in SPAM), F.lit(0)) >= 4


def releases(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """The release schema with the given columns, NULL for the others; empty strings are NULL."""
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(RELEASE).fields
    blank = lambda f: F.nullif(F.trim(cols[f.name].cast("string")), F.lit("")) if f.dataType.simpleString() == "string" else cols[f.name].cast(f.dataType)
    return df.select(*((blank(f) if f.name in cols else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields))


def accepted(df: DataFrame) -> DataFrame:
    return df.where("skip_reason IS NULL").drop("skip_reason")


def _ids(**k: Column) -> Column:
    m = F.create_map(*[x for name, c in k.items() for x in (F.lit(name), c.cast("string"))])
    return F.map_filter(m, lambda _, v: F.coalesce(v, F.lit("")) != "")


def _contribs(people: Column, f: Callable[[Column, Column], dict[str, Column]]) -> Column:
    kinds = {"raw_name": "string", "given_name": "string", "surname": "string", "role": "string", "raw_affiliation": "string", "position": "int", "extra": "map<string,string>"}
    def one(x, i):
        c = f(x, i)
        return F.struct(*((c[n] if n in c else F.lit(None)).cast(kind).alias(n) for n, kind in kinds.items()))

    return F.transform(F.coalesce(people, F.array()), one)


def _abstract(body: Column, language: Column, mimetype: str, strict: bool) -> Column:
    """One abstract of at least 75 bytes (more than 75 where `strict`)."""
    size = F.octet_length(body)
    ok = size > 75 if strict else size >= 75
    one = F.struct(F.sha1(body.cast("binary")).alias("sha1"), F.lit(mimetype).alias("mimetype"), language.alias("language"), body.alias("content"))
    return F.when(ok, F.array(one))


def _has(df: DataFrame, path: str) -> bool:
    """Whether a column, or a field within structs and arrays of structs, is there."""
    kind = df.schema
    for name in path.split("."):
        kind = getattr(kind, "elementType", kind)
        if name not in getattr(kind, "names", ()):
            return False
        kind = kind[name].dataType
    return True


def _maybe(df: DataFrame, path: str, kind: str) -> Column:
    """A column of records that not every writer gives."""
    return F.col(path) if _has(df, path) else F.lit(None).cast(kind)


def _extra(**k: Column) -> Column:
    """Of one contributor: what is given, NULL if nothing is."""
    m = _ids(**k)
    return F.when(F.size(m) > 0, m)


def _abstracts(bodies: Column, language: Column, mimetype: str = "text/plain") -> Column:
    """Each of at least 75 bytes."""
    long = F.filter(F.coalesce(bodies, F.array().cast("array<string>")), lambda x: F.octet_length(x) >= 75)
    return F.transform(long, lambda x: F.struct(F.sha1(x.cast("binary")).alias("sha1"), F.lit(mimetype).alias("mimetype"), language.alias("language"), x.alias("content")))


def crossref_skip(title: Column, kind: Column, doi: Column, refs: Column, people: Column) -> Column:
    first = F.try_element_at(title, F.lit(1))
    return first_reason(
        [
            ("no-titles", first.isNull()),
            ("short-title", F.octet_length(first) < 2),
            ("filtered-title", F.lower(first) == "oup accepted manuscript"),
            ("filtered-type", F.coalesce(kind, F.lit("")).isin(*CROSSREF_IGNORED)),
            ("empty-doi", F.coalesce(doi, F.lit("")) == ""),
            ("too-many-refs", refs > 5000),
            ("too-many-authors", people > 2000),
        ]
    )


def crossref(df: DataFrame) -> DataFrame:
    """Columns as upstream: DOI, type, title, author, editor, translator, license, reference, issued, abstract, ..."""
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    people = []
    for role in ("author", "editor", "translator"):
        def person(x, i, role=role):
            both = F.concat_ws(" ", F.nullif(x["given"], F.lit("")), F.nullif(x["family"], F.lit("")))
            named = F.coalesce(F.nullif(F.coalesce(x["family"], F.lit("")), F.lit("")), F.nullif(F.coalesce(x["name"], F.lit("")), F.lit("")))
            raw = F.when(F.coalesce(x["given"], F.lit("")) != "", both).otherwise(named)
            aff = F.filter(F.transform(x["affiliation"], lambda a: a["name"]), lambda a: F.coalesce(a, F.lit("")) != "")
            return {"raw_name": raw, "given_name": x["given"], "surname": x["family"], "role": F.lit(role), "raw_affiliation": F.try_element_at(aff, F.lit(1)), "position": i}

        people.append(_contribs(F.col(role), person))
    vor = F.filter("license", lambda x: x["content-version"].isin("vor", "unspecified"))
    parts = F.try_element_at(F.col("issued.date-parts"), F.lit(1))
    date = dates.parts_date(parts)
    lang = text.language(F.col("language"))
    prefix = F.upper("DOI")

    given = {f.name.lower(): f.name for f in df.schema["reference"].dataType.elementType}

    def ref(r, i):
        extra = {k: r[given[c.lower()]] for k, c in REFERENCE_EXTRA.items() if c.lower() in given}
        extra["authors"] = F.when(F.coalesce(r["author"], F.lit("")) != "", F.to_json(F.array(r["author"])))  # a list, of one
        filled = F.map_filter(F.create_map(*[v for k, c in extra.items() for v in (F.lit(k), c)]), lambda _, v: F.coalesce(v, F.lit("")) != "")
        key = F.when(F.startswith(r["key"], prefix), F.substr(r["key"], F.length(prefix) + 1)).otherwise(r["key"])
        name = F.coalesce(F.nullif(r["volume-title"], F.lit("")), r["journal-title"])
        return F.struct(i.alias("index"), key.alias("key"), r["year"].try_cast("int").alias("year"), name.alias("container_name"), r["first-page"].alias("locator"), r["article-title"].alias("title"), filled.alias("extra"))

    doi = ids.clean_doi(F.col("DOI"))
    body = text.clean_string(text.detag(F.col("abstract")))
    return releases(df, {
        "id": ids.source_id("crossref", doi), "source": F.lit("crossref"), "title": F.try_element_at("title", F.lit(1)), "subtitle": F.try_element_at("subtitle", F.lit(1)), "original_title": F.try_element_at("original-title", F.lit(1)),
        "release_type": text.lookup(F.col("type"), CROSSREF_TYPES), "release_stage": F.when(F.col("type").isin(*CROSSREF_PUBLISHED), "published"), "release_date": date, "release_year": F.when(date.isNull(), F.try_element_at(parts, F.lit(1))),
        "volume": F.col("volume"), "issue": F.col("issue"), "pages": F.col("page"), "publisher": F.col("publisher"), "language": lang,
        "license_slug": text.licence_slug(F.try_element_at(F.transform(vor, lambda x: x["URL"]), F.lit(-1))),
        "extids": _ids(doi=doi, isbn13=F.try_element_at(F.filter("ISBN", lambda x: F.length(x) == 17), F.lit(1))), "contribs": F.concat(*people),
        "abstracts": _abstract(body, lang, "application/xml+jats", strict=True), "refs": F.transform(F.coalesce(F.col("reference"), F.array()), ref), "extra": F.to_json(F.struct(F.struct(F.col("type"), F.col("container-title")).alias("crossref"))),
        "skip_reason": crossref_skip(F.col("title"), F.col("type"), F.col("DOI"), size("reference"), size("author") + size("editor") + size("translator")),
    })


#: Fields of references that are kept under a name of their own (fixed values).
REFERENCE_EXTRA = {
    "journal-title": "journal-title", "DOI": "DOI", "editor": "editor", "edition": "edition", "authority": "authority", "version": "version", "genre": "genre", "url": "url", "event": "event", "issue": "issue", "volume": "volume", "date": "date",
    "accessed_date": "accessed_date", "page": "page", "medium": "medium", "collection_title": "collection_title", "chapter_number": "chapter_number", "unstructured": "unstructured", "series-title": "series-title",
}
#: Types of dates, the best first (fixed values).
DATE_ORDER = ("Valid", "Available", "Accepted", "Submitted", "Copyrighted", "Created", "Updated")


def best_date(found: Column, today: str) -> Column:
    """struct(date, year, month) of an array of (date, dateType): the first that can be read of the best type that has one, else the first of any type."""
    rank = lambda kind: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, DATE_ORDER)), kind), F.lit(0)), F.lit(len(DATE_ORDER) + 1))
    read = F.filter(F.transform(found, lambda d, i: F.struct(rank(d["dateType"]).alias("rank"), i.alias("i"), dates.partial_date(d["date"], today).alias("d"))), lambda x: x["d"].isNotNull())
    return F.array_min(read)["d"]


def datacite_type(doi: Column, title: Column, kind: Column) -> Column:
    """The type with what is known of some prefixes and titles."""
    kind = F.when((title == "GBIF Occurrence Download") & F.startswith(doi, F.lit("10.15468/dl.")), "stub").otherwise(kind)
    kind = F.when(F.startswith(doi, F.lit("10.5517/")), "entry").otherwise(kind)
    kind = F.when(F.startswith(F.lower(title), F.lit("additional file")) & kind.isin("article", "article-journal"), "component").otherwise(kind)
    part = doi.rlike(r"^10\.6084/|^10\.25384") & F.contains(title, F.lit(" from ")) & ~F.coalesce(kind, F.lit("")).isin("stub", "graphic") & title.rlike("^(Figure|Table) ")
    return F.when(part, "component").otherwise(kind)


def datacite_version(doi: Column, version: Column) -> Column:
    """The version, which some identifiers end with."""
    own = F.when(doi.rlike(r"^10\.6084/|^10\.25384"), F.nullif(F.regexp_extract(doi, r"\.(v\d+)$", 1), F.lit("")))
    return F.coalesce(own, version)


def datacite_titles(titles: Column) -> Column:
    """struct(title, subtitle, original): a sole title is the title whatever its type; a translated one is the original if it says something else."""
    of = lambda kind: F.filter(titles, lambda x: F.coalesce(x["titleType"], F.lit("")) == kind)
    said = lambda xs: F.try_element_at(F.filter(F.transform(xs, lambda x: F.trim(x["title"])), lambda x: F.coalesce(x, F.lit("")) != ""), F.lit(1))
    several, plain = F.size(titles) > 1, said(of(""))
    other = F.filter(of("TranslatedTitle"), lambda x: (F.octet_length(F.trim(x["title"])) >= 4) & ~F.trim(x["title"]).eqNullSafe(plain) & (F.length(F.regexp_replace(x["title"], "[^?]", "")) <= 3))
    return F.struct(F.when(several, F.coalesce(plain, F.trim(F.try_element_at(titles, F.lit(1))["title"]))).otherwise(F.trim(F.try_element_at(titles, F.lit(1))["title"])).alias("title"), F.when(several, said(of("Subtitle"))).alias("subtitle"), F.when(several, said(other)).alias("original"))


#: Names that stand for a service and no person (fixed values).
NO_PERSONS = ("Occdownload Gbif.Org",)


def _datacite_people(df: DataFrame, column: str) -> Column:
    """Persons by their name in display form, else by given and family name; bodies by name; other kinds of names are left out. Positions count those that stay."""
    clean = lambda c: F.coalesce(text.clean_string(c), F.lit(""))
    kind = lambda x: F.coalesce(x["nameType"], F.lit("")) if _has(df, f"{column}.nameType") else F.lit("")
    identifiers = lambda x: x["nameIdentifiers"] if _has(df, f"{column}.nameIdentifiers") else F.lit(None).cast("array<struct<nameIdentifier:string,nameIdentifierScheme:string>>")
    role = lambda x: x["contributorType"] if _has(df, f"{column}.contributorType") else F.lit(None).cast("string")

    def person(x):
        body = kind(x) == "Organizational"
        name, given, surname = clean(x["name"]), clean(x["givenName"]), clean(x["familyName"])
        shown = F.trim(F.when(name == "", F.concat_ws(" ", given, surname)).otherwise(text.index_to_display(name)))
        ok = F.when(body, ~is_unknown(x["name"]) & (F.octet_length(x["name"]) >= 3)).otherwise(kind(x).isin("", "Personal") & ~is_unknown(shown) & ~shown.isin("", *NO_PERSONS))
        orcid = F.try_element_at(F.filter(identifiers(x), lambda i: F.lower(i["nameIdentifierScheme"]) == "orcid"), F.lit(1))["nameIdentifier"]
        return F.struct(
            F.coalesce(ok, F.lit(False)).alias("ok"), F.when(~body, shown).alias("raw_name"), F.when(~body, given).alias("given_name"), F.when(~body, surname).alias("surname"),
            F.when(~body, text.clean_string(F.try_element_at(x["affiliation"], F.lit(1))["name"])).alias("raw_affiliation"),
            F.when(body, _extra(organization=x["name"])).otherwise(_extra(type=role(x), orcid=F.regexp_replace(orcid, "^https?://orcid\\.org/", ""))).alias("extra"),
        )

    kept = F.filter(F.transform(F.coalesce(F.col(column), F.array()), person), lambda x: x["ok"])
    named = lambda x, i: {n: x[n] for n in ("raw_name", "given_name", "surname", "raw_affiliation", "extra")} | {"role": F.lit("author"), "position": i}
    return F.transform(dedup_contribs(_contribs(kept, named)), lambda x, i: x.withField("position", i))


def datacite_slug(uri: Column) -> Column:
    """The licence of an address; statements of rights by the name that they have there, of at most nine bytes."""
    stated = F.regexp_extract(uri, r"/(?:vocab|page)/([^/]+)", 1)
    return F.coalesce(F.nullif(text.licence_slug(uri), F.lit("")), F.when(F.contains(uri, F.lit("rightsstatements.org")) & (stated != "") & (F.octet_length(stated) <= 9), F.concat(F.lit("RS-"), F.upper(stated))))


def datacite(df: DataFrame, today: str) -> DataFrame:
    """Columns: the fields of `attributes`."""
    single = lambda c: dates.partial_date(c, today)
    found = F.coalesce(best_date(F.col("dates"), today), F.when(F.col("publicationYear") > 0, single(F.col("publicationYear").cast("string"))), single(_maybe(df, "published", "string")))
    named = F.concat(_datacite_people(df, "creators"), _datacite_people(df, "contributors"))
    df = df.withColumns({"__titles": datacite_titles(F.col("titles")), "__date": found, "__people": named})  # each is used more than once
    titles, date = F.col("__titles"), F.col("__date")
    title = titles["title"]
    kind = F.lit(None).cast("string")
    for schema, table in reversed(DATACITE_TYPES.items()):
        kind = F.coalesce(text.lookup(F.col(f"types.{schema}"), table), kind)
    figshare = F.col("doi").rlike(r"^(10\.6084/|10\.25384)") & (F.col("types.resourceType") == "Collection")
    publisher = F.trim("publisher")
    nameless = F.coalesce(is_unknown(publisher) | (publisher == "Unpublished"), F.lit(False))
    lang, doi = text.language(F.col("language")), F.lower(F.trim("doi"))
    said = F.transform(F.filter("descriptions", lambda d: d["descriptionType"] == "Abstract"), lambda d: F.trim(d["description"]))
    said = F.transform(said, lambda x: F.when(F.octet_length(x) > LONGEST, F.concat(F.decode(F.substring(F.encode(x, "utf-8"), 1, LONGEST), "utf-8"), F.lit(" [...]"))).otherwise(x))
    rights = F.filter(F.transform("rightsList", lambda r: datacite_slug(r["rightsUri"])), lambda x: x.isNotNull())
    related = _maybe(df, "relatedIdentifiers", "array<struct<relationType:string,relatedIdentifier:string,relatedIdentifierType:string>>")
    has = lambda k: F.coalesce(F.exists(related, lambda r: r["relationType"] == k), F.lit(False))
    cited = F.filter(F.coalesce(related, F.array()), lambda r: r["relationType"].isin("References", "Cites"))
    nil = F.lit(None).cast("string")
    refs = F.transform(cited, lambda r, i: F.struct(i.alias("index"), nil.alias("key"), F.lit(None).cast("int").alias("year"), nil.alias("container_name"), nil.alias("locator"), nil.alias("title"), _extra(doi=F.when(r["relatedIdentifierType"] == "DOI", r["relatedIdentifier"])).alias("extra")))
    variant = F.startswith(doi, F.lit("10.7916/")) & F.contains(doi, F.lit("-")) & (text.clean_string(publisher) == "Columbia University") & has("IsVariantFormOf")
    first, last = F.nullif("container.firstPage", F.lit("")), F.nullif("container.lastPage", F.lit(""))
    clean = text.clean_string(title)
    return releases(df, {
        "id": ids.source_id("datacite", doi), "source": F.lit("datacite"), "title": clean, "subtitle": text.clean_string(titles["subtitle"]), "original_title": titles["original"],
        "release_type": datacite_type(doi, clean, F.when(has("Reviews"), "review").otherwise(F.when(kind.isNull() & figshare, "stub").otherwise(kind))), "release_stage": F.when(F.coalesce(variant, F.lit(False)), "submitted").when(~nameless, "published"),
        "release_date": date["date"], "release_year": date["year"], "volume": text.clean_string(F.trim("container.volume")), "issue": text.clean_string(F.trim("container.issue")), "pages": F.when(first.isNotNull(), F.concat_ws("-", first, last)),
        "publisher": F.when(~nameless & (F.octet_length(publisher) <= 80), text.clean_string(publisher)), "version": datacite_version(doi, F.when(~is_unknown(F.col("version")), F.col("version"))), "language": lang,
        "license_slug": F.try_element_at(rights, F.lit(-1)), "extids": _ids(doi=doi), "contribs": dedup_contribs(F.col("__people")), "abstracts": _abstracts(said, F.lit(None).cast("string")), "refs": refs,
        "extra": F.to_json(F.struct(F.struct(F.nullif("types.resourceType", F.lit("")).alias("resourceType"), F.nullif("types.resourceTypeGeneral", F.lit("")).alias("resourceTypeGeneral")).alias("datacite"), F.when(F.startswith(doi, F.lit("10.6084/m9.figshare.")), "figshare.com").alias("container_name"), date["month"].alias("release_month"))),
        "skip_reason": first_reason([("no-doi", F.coalesce(doi, F.lit("")) == ""), ("non-ascii-doi", ~text.is_ascii(doi)), ("no-title", F.coalesce(title, F.lit("")) == ""), ("spam-title", is_spam(title))]),
    })


LONGEST = 32000  # bytes of an abstract; longer ones are cut and say so


def dedup_contribs(people: Column) -> Column:
    """The first of each (name, role), order kept; bodies, which have no such name, are one another's copies only if they are the same body."""
    same = lambda a, b: a["raw_name"].eqNullSafe(b["raw_name"]) & a["role"].eqNullSafe(b["role"]) & F.try_element_at(a["extra"], F.lit("organization")).eqNullSafe(F.try_element_at(b["extra"], F.lit("organization")))
    return F.aggregate(people, F.array().cast(f"array<{CONTRIB}>"), lambda acc, x: F.when(F.exists(acc, lambda y: same(x, y)), acc).otherwise(F.concat(acc, F.array(x))))


def arxiv(df: DataFrame) -> DataFrame:
    """Flat records: identifier, status, id, title, authors, abstract, doi, created, license, journal_ref, report_no, and maybe datestamp."""
    journal = F.lower(F.coalesce("journal_ref", F.lit("")))
    conference = journal.rlike(r"conf\.|proc\.|proceedings|workshop")
    own = F.coalesce(F.nullif(F.trim("id"), F.lit("")), F.nullif(F.regexp_replace(_maybe(df, "identifier", "string"), "^oai:arXiv\\.org:", ""), F.lit("")))
    key = ids.arxiv_versioned(own)
    day = F.coalesce(F.nullif("created", F.lit("")), _maybe(df, "datestamp", "string"))
    date = F.to_date(F.try_to_timestamp(F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day), F.lit("yyyy-MM-dd")))

    def person(x, i):
        fore, keyname = F.nullif(x["forename"], F.lit("")), F.nullif(x["keyname"], F.lit(""))
        return {"raw_name": F.when(keyname.isNotNull(), F.concat_ws(" ", fore, keyname)), "given_name": fore, "surname": keyname, "role": F.lit("author"), "raw_affiliation": x["affiliation"], "position": i, "extra": _extra(suffix=x["suffix"] if _has(df, "authors.suffix") else F.lit(None).cast("string"))}

    return releases(df, {
        "id": ids.source_id("arxiv", key), "source": F.lit("arxiv"), "title": text.clean_string(F.trim(text.one_line(F.col("title")))), "release_type": F.when(conference, "paper-conference").when(F.coalesce("report_no", F.lit("")) != "", "report").otherwise("article-journal"),
        "release_stage": F.lit("submitted"), "release_date": date, "release_year": F.substring(day, 1, 4).try_cast("int"), "language": F.lit("en"), "license_slug": text.licence_slug(F.col("license")),
        "extids": _ids(arxiv=key, doi=ids.clean_doi(F.col("doi"))), "contribs": _contribs(F.col("authors"), person), "abstracts": _abstracts(F.array(F.trim("abstract")), F.lit(None).cast("string")),
        "extra": F.to_json(F.struct(F.struct(F.nullif("journal_ref", F.lit("")).alias("journal_ref"), F.nullif("report_no", F.lit("")).alias("report_no")).alias("arxiv"))),
        "skip_reason": first_reason([("no-arxiv-id", own.isNull()), ("deleted", F.col("status") == "deleted"), ("empty-title", F.coalesce(F.trim("title"), F.lit("")) == ""), ("too-many-authors", F.size("authors") > 2000)]),
    })


def doaj(df: DataFrame) -> DataFrame:
    """Flat records: id, status, title, publisher, publication_date, doi, language, abstract, authors(name, affiliation, orcid_id), license_ref, ..."""
    raw = F.col("publication_date")
    date = F.coalesce(F.to_date(F.try_to_timestamp(raw, F.lit("yyyy-MM-dd"))), F.to_date(F.try_to_timestamp(F.when(F.length(raw) == 4, raw), F.lit("yyyy"))))
    lang = text.language(F.col("language"))

    def person(x, i):
        """A name is taken apart at its first comma only."""
        comma = F.instr(x["name"], ",") > 1
        return {"raw_name": x["name"], "given_name": F.when(comma, F.trim(F.regexp_replace(x["name"], "^[^,]*,", ""))), "surname": F.when(comma, F.trim(F.substring_index(x["name"], ",", 1))), "role": F.lit("author"), "raw_affiliation": x["affiliation"], "position": i}

    slug = F.regexp_extract(F.lower("license_ref"), r"creativecommons\.org/licenses/([^/]+)", 1)
    start, end = F.nullif("start_page", F.lit("")), F.nullif("end_page", F.lit(""))
    return releases(df, {
        "id": F.concat(F.lit("doaj-"), F.col("id")), "source": F.lit("doaj"), "title": text.clean_string(F.trim("title")), "release_type": F.lit("article-journal"), "release_stage": F.lit("published"), "release_date": date,
        "release_year": F.substring(raw, 1, 4).try_cast("int"), "volume": F.col("volume"), "issue": F.col("issue"), "pages": F.when(start.isNotNull(), F.concat_ws("-", start, end)), "publisher": F.col("publisher"),
        "language": lang, "license_slug": F.when(slug != "", F.concat(F.lit("cc-"), slug)), "extids": _ids(doaj=F.col("id"), doi=ids.clean_doi(F.col("doi"))), "contribs": F.filter(_contribs(F.col("authors"), person), lambda x: F.coalesce(x["raw_name"], F.lit("")) != ""),
        "abstracts": _abstracts(F.array(F.trim("abstract")), F.lit(None).cast("string")),
        "skip_reason": first_reason([("no-doaj-id", F.coalesce("id", F.lit("")) == ""), ("deleted", F.col("status") == "deleted"), ("empty-title", F.coalesce(F.trim("title"), F.lit("")) == ""), ("too-many-authors", F.size("authors") > 2000)]),
    })


STUB_TITLES = ("in process citation", "not available", "oup accepted manuscript")


def pubmed_date(year: Column, month: Column, day: Column, medline: Column, today: str) -> Column:
    """struct(date, year): a year out of range, or none, is NULL; a month by its English abbreviation or two digits."""
    ok = lambda y: F.when(y.between(F.lit(1300), F.year(F.lit(today).cast("date")) + 5), y)
    own = ok(year.try_cast("int"))
    numbers = F.create_map(*[x for i, m in enumerate(dates.MONTHS) for x in (F.lit(m.capitalize()), F.lit(f"{i + 1:02d}"))])
    mm = F.coalesce(F.try_element_at(numbers, month), F.when(month.rlike(r"^\d{2}$"), month))
    date = F.to_date(F.try_to_timestamp(F.when(day.rlike(r"^\d{1,2}$"), F.concat_ws("-", own.cast("string"), mm, F.lpad(day, 2, "0"))), F.lit("yyyy-MM-dd")))
    given = F.coalesce(year, F.lit("")) != ""
    found = F.when(given, own).otherwise(ok(dates.medline_year(medline)))
    return F.when(found.isNotNull(), F.struct(F.when(given & mm.isNotNull(), date).alias("date"), found.alias("year")))


def pubmed(df: DataFrame, today: str) -> DataFrame:
    """Flat articles: pmid, title, vernacular_title, publication_types, authors(fore_name, last_name, collective_name, affiliation), year, month, day, medline_date, language, abstract_parts(label, text), article_ids(id_type, value), ...

    Maybe also electronic(year, month, day), elocation_ids(id_type, valid, value), corrections(ref_type, ref_source, pmid), other_abstracts(language, texts), authors' more_affiliations, complete_authors, and
    category of the parts of an abstract, which are one text where the first has one.
    """
    bare = lambda c: F.trim(F.regexp_replace(F.coalesce(text.clean_string(c), F.lit("")), r"\.+$", ""))
    title, vernacular = F.regexp_replace(F.regexp_replace(bare(F.col("title")), r"\]$", ""), r"^\[", ""), bare(F.col("vernacular_title"))
    either = F.coalesce(F.nullif(title, F.lit("")), vernacular)
    stub = F.coalesce(F.nullif(text.clean_string(F.col("title")), F.lit("")), text.clean_string(F.col("vernacular_title")))
    stub = F.lower(F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(stub, r"\.+$", ""), r"\]$", ""), r"^\[", "")))
    printed = pubmed_date(F.col("year"), F.col("month"), F.col("day"), F.col("medline_date"), today)
    nil = F.lit(None).cast("string")
    date = F.coalesce(pubmed_date(F.col("electronic.year"), F.col("electronic.month"), F.col("electronic.day"), nil, today), printed) if _has(df, "electronic") else printed
    kinds = F.filter(F.transform("publication_types", lambda t: text.lookup(t, PUBMED_TYPES)), lambda x: x.isNotNull())
    has = lambda k: F.coalesce(F.array_contains("publication_types", k), F.lit(False))
    of = lambda k: F.trim(F.try_element_at(F.filter("article_ids", lambda x: x["id_type"] == k), F.lit(-1))["value"])
    places = _maybe(df, "elocation_ids", "array<struct<id_type:string,valid:string,value:string>>")
    place = F.trim(F.try_element_at(F.filter(places, lambda x: (x["id_type"] == "doi") & (F.coalesce(x["valid"], F.lit("")) != "N")), F.lit(1))["value"])
    notes = _maybe(df, "corrections", "array<struct<ref_type:string,ref_source:string,pmid:string>>")
    note = lambda k: F.try_element_at(F.filter(notes, lambda x: x["ref_type"] == k), F.lit(1))
    texts = F.transform("abstract_parts", lambda p: p["text"])
    whole = F.array(F.array_join(F.filter(texts, lambda x: F.coalesce(x, F.lit("")) != ""), "\n"))
    one = F.coalesce(F.try_element_at("abstract_parts", F.lit(1))["category"], F.lit("")) != "" if _has(df, "abstract_parts.category") else F.lit(False)
    others = F.transform(_maybe(df, "other_abstracts", "array<struct<language:string,texts:array<string>>>"), lambda a: _abstracts(a["texts"], F.coalesce(F.nullif(text.language(a["language"]), F.lit("")), F.lit("en"))))
    more = F.when(has("Retraction of Publication"), F.struct(note("RetractionOf")["ref_source"].alias("raw"), note("RetractionOf")["pmid"].alias("pmid")))

    def person(x, i):
        fore, last = F.nullif(x["fore_name"], F.lit("")), F.nullif(x["last_name"], F.lit(""))
        further = x["more_affiliations"] if _has(df, "authors.more_affiliations") else F.lit(None).cast("array<string>")
        return {"raw_name": F.when(last.isNotNull(), F.concat_ws(" ", fore, last)).otherwise(x["collective_name"]), "given_name": fore, "surname": last, "role": F.lit("author"), "raw_affiliation": x["affiliation"], "position": i, "extra": _extra(more_affiliations=F.when(F.size(further) > 0, F.to_json(further)))}

    people = _contribs(F.col("authors"), person)
    if _has(df, "complete_authors"):
        rest = _contribs(F.array(F.lit("et al.")), lambda x, i: {"raw_name": x, "role": F.lit("author")})
        people = F.when(F.col("complete_authors") == "N", F.concat(people, rest)).otherwise(people)
    marc = F.col("language")
    return releases(df, {
        "id": ids.source_id("pubmed", F.trim("pmid")), "source": F.lit("pubmed"), "title": either, "original_title": F.when(title != "", vernacular), "release_type": F.when(has("Retraction of Publication"), "retraction").otherwise(F.try_element_at(kinds, F.lit(1))),
        "release_stage": F.when(has("Retraction of Publication"), "retraction").when(has("Corrected and Republished Article"), "updated").otherwise("published"), "withdrawn_status": F.when(has("Retracted Publication"), "retracted").when(note("ExpressionOfConcernIn").isNotNull(), "concern"),
        "release_date": date["date"], "release_year": date["year"], "volume": F.col("volume"), "issue": F.col("issue"), "pages": F.col("pages"), "language": F.when(~F.coalesce(marc, F.lit("")).isin("und", "un"), text.language(marc)),
        "extids": _ids(pmid=F.trim("pmid"), doi=F.lower(F.coalesce(F.nullif(of("doi"), F.lit("")), place)), pmcid=F.upper(of("pmc"))),
        "contribs": people, "abstracts": F.concat(F.when(one, _abstracts(whole, F.lit("en"))).otherwise(_abstracts(texts, F.lit("en"))), F.coalesce(F.flatten(others), F.array())),
        "extra": F.to_json(F.struct(F.struct(F.col("publication_types").alias("pub_types"), more["raw"].alias("retraction_of_raw"), more["pmid"].alias("retraction_of_pmid")).alias("pubmed"))),
        "skip_reason": first_reason([("no-pmid", F.coalesce("pmid", F.lit("")) == ""), ("empty-title", F.coalesce(stub, F.lit("")) == ""), ("stub-title", stub.isin(*STUB_TITLES)), ("too-many-authors", F.size("authors") > 2000), ("too-many-refs", F.coalesce(F.col("n_refs"), F.lit(0)) > 5000)]),
    })


def oai(df: DataFrame) -> DataFrame:
    """Flat Dublin Core: oai, status, datestamp, titles, creators, identifiers, dates, languages, descriptions."""
    doi = F.try_element_at(F.filter(F.transform("identifiers", ids.clean_doi), lambda x: x.isNotNull()), F.lit(1))
    def person(x, i):
        n = text.split_name(F.trim(x))
        return {"raw_name": F.trim(x), "given_name": n["given"], "surname": n["surname"], "position": i}

    title = F.trim(F.try_element_at("titles", F.lit(1)))
    date = F.to_date(F.try_to_timestamp(F.substring(F.try_element_at("dates", F.lit(1)), 1, 10), F.lit("yyyy-MM-dd")))
    return releases(df, {
        "id": ids.source_id("oaiscrape", F.col("oai")), "source": F.lit("oaiscrape"), "title": title, "release_date": date, "release_year": F.coalesce(F.year(date), F.substring(F.try_element_at("dates", F.lit(1)), 1, 4).try_cast("int")),
        "language": text.language(F.try_element_at("languages", F.lit(1))), "extids": _ids(oai=F.col("oai"), doi=doi), "contribs": _contribs(F.col("creators"), person),
        "skip_reason": first_reason([("deleted", F.col("status") == "deleted"), ("empty-title", F.coalesce(title, F.lit("")) == "")]),
    })


def openalex(df: DataFrame) -> DataFrame:
    """Columns: ids, doi, title, authorships, biblio, publication_date, publication_year, language, primary_location."""
    pages = F.concat_ws("-", F.nullif("biblio.first_page", F.lit("")), F.nullif("biblio.last_page", F.lit("")))
    person = lambda x, i: {"raw_name": x["raw_author_name"], "role": F.lit("author"), "position": i}
    cut = lambda c, p: F.replace(c, F.lit(p), F.lit(""))
    return releases(df, {
        "id": ids.source_id("openalex", F.col("ids.openalex")), "source": F.lit("openalex"), "title": F.col("title"), "release_date": F.col("publication_date").try_cast("date"), "release_year": F.col("publication_year"),
        "volume": F.col("biblio.volume"), "issue": F.col("biblio.issue"), "pages": pages, "language": F.col("language"), "contribs": _contribs(F.col("authorships"), person),
        "extids": _ids(doi=ids.clean_doi(F.col("doi")), pmid=cut(F.col("ids.pmid"), "https://pubmed.ncbi.nlm.nih.gov/"), pmcid=cut(F.col("ids.pmcid"), "https://www.ncbi.nlm.nih.gov/pmc/articles/"), openalex=cut(F.col("ids.openalex"), "https://openalex.org/"), mag=F.col("ids.mag")),
        "skip_reason": first_reason([("no-id", F.coalesce("ids.openalex", F.lit("")) == "")]),
    })


def dblp(df: DataFrame) -> DataFrame:
    """Columns: key, title, author array<string>, year, volume, number, pages, ee array<string>."""
    doi = F.try_element_at(F.filter(F.transform("ee", ids.clean_doi), lambda x: x.isNotNull()), F.lit(1))
    def person(x, i):
        n = text.split_name(x)
        return {"raw_name": x, "given_name": n["given"], "surname": n["surname"], "role": F.lit("author"), "position": i}

    return releases(df, {
        "id": ids.source_id("dblp", F.col("key")), "source": F.lit("dblp"), "title": F.regexp_replace("title", r"\.$", ""), "release_year": F.col("year").try_cast("int"), "volume": F.col("volume"), "issue": F.col("number"), "pages": F.col("pages"),
        "extids": _ids(dblp=F.col("key"), doi=doi), "contribs": _contribs(F.col("author"), person), "skip_reason": first_reason([("no-key", F.coalesce("key", F.lit("")) == "")]),
    })


def tei(df: DataFrame) -> DataFrame:
    """Flat headers of extracted papers: file, title, language, publisher, date, volume, issue, pages, doi, pmid, pmcid, arxiv, authors(full_name, given_name, surname, institution, department), abstract."""
    raw = F.coalesce("date", F.lit(""))
    date = F.when(F.length(raw) == 10, F.to_date(F.try_to_timestamp(raw, F.lit("yyyy-MM-dd"))))
    year = F.when((F.length(raw) > 4) & (F.length(raw) != 10), F.nullif(F.regexp_extract(raw, "^([0-9]{4})-", 1), F.lit(""))).cast("int")
    lang, body = text.language(F.col("language")), text.clean_string(text.detag(F.col("abstract")))
    person = lambda x, i: {"raw_name": x["full_name"], "given_name": x["given_name"], "surname": x["surname"], "role": F.lit("author"), "raw_affiliation": F.concat_ws(" ", F.coalesce(x["institution"], F.lit("")), F.nullif(x["department"], F.lit(""))), "position": i}
    return releases(df, {
        "id": ids.source_id("tei", F.col("file")), "source": F.lit("tei"), "title": F.col("title"), "release_type": F.lit("article-journal"), "release_stage": F.when(F.coalesce("arxiv", F.lit("")) != "", "submitted").otherwise("published"), "release_date": date, "release_year": year,
        "volume": F.col("volume"), "issue": F.col("issue"), "pages": F.col("pages"), "publisher": F.col("publisher"), "language": lang, "extids": _ids(doi=F.col("doi"), pmid=F.col("pmid"), pmcid=F.col("pmcid"), arxiv=F.col("arxiv")), "contribs": _contribs(F.col("authors"), person),
        "abstracts": _abstract(body, lang, "application/xml+jats", strict=True),
    })


def tei_ids(df: DataFrame) -> DataFrame:
    """(file, id_type, id_value): the identifiers that a header gives."""
    return df.select("file", "doi", "pmid", "pmcid", "arxiv").unpivot("file", ["doi", "pmid", "pmcid", "arxiv"], "id_type", "id_value").where("id_value IS NOT NULL AND id_value <> ''")


CONVERTERS = {"tei": tei, "crossref": crossref, "datacite": datacite, "arxiv": arxiv, "doaj": doaj, "pubmed": pubmed, "oai": oai, "openalex": openalex, "dblp": dblp}


def convert(df: DataFrame, source: str, **options) -> DataFrame:
    return CONVERTERS[source](df, **options)


#: Roles that a citation object names, in order (fixed values).
CSL_ROLES = ("author", "collection-editor", "composer", "container-author", "director", "editor", "editorial-director", "interviewer", "illustrator", "original-author", "recipient", "reviewed-author", "translator")


def csl_json(df: DataFrame) -> DataFrame:
    """(id, csl): a release as one citation object without empty keys; NULL where nobody has a surname.

    Columns of a release, and maybe container(name, issnl, publisher) and, of contributors, creator(display_name, given_name, surname).
    """
    given = lambda c: F.nullif(c, F.lit(""))
    known = _has(df, "contribs.creator")

    def person(x):
        by = (lambda own, of: F.coalesce(given(x["creator"][own]), given(x[of]))) if known else (lambda own, of: given(x[of]))
        last = F.element_at(F.split(F.trim(x["raw_name"]), r"\s+"), -1)
        return F.struct(F.coalesce(by("surname", "surname"), given(last)).alias("family"), by("given_name", "given_name").alias("given"), F.coalesce(given(x["role"]), F.lit("author")).alias("role"))

    people = F.filter(F.transform(F.coalesce("contribs", F.array()), person), lambda x: x["family"].isNotNull())
    role = lambda r: F.transform(F.filter(people, lambda x: x["role"] == r), lambda x: F.struct(x["family"].alias("family"), x["given"].alias("given")))
    some = lambda c: F.when(F.size(c) > 0, c)
    day = F.col("release_date")
    issued = F.when(day.isNotNull(), F.array(F.year(day), F.month(day), F.day(day))).when(F.col("release_year") != 0, F.array("release_year"))
    ext = lambda k: given(F.try_element_at("extids", F.lit(k)))
    of = lambda k: given(_maybe(df, f"container.{k}", "string"))
    obj = F.struct(
        F.coalesce(given("release_type"), F.lit("article")).alias("type"), given("language").alias("language"), F.when(issued.isNotNull(), F.struct(F.array(issued).alias("date-parts"))).alias("issued"), given(F.try_element_at("abstracts", F.lit(1))["content"]).alias("abstract"),
        of("name").alias("container-title"), ext("doi").alias("DOI"), ext("isbn13").alias("ISBN"), of("issnl").alias("ISSN"), given("issue").alias("issue"), given(F.substring_index("pages", "-", 1)).alias("page-first"), ext("pmcid").alias("PMCID"), ext("pmid").alias("PMID"),
        F.coalesce(of("publisher"), given("publisher")).alias("publisher"), given("title").alias("title"), given("volume").alias("volume"), *(some(role(r)).alias(r) for r in CSL_ROLES),
    )
    return df.select("id", F.when(F.size(people) > 0, F.to_json(obj)).alias("csl"))


#: Identifiers of the flat table, in order (fixed values).
TABULAR = ("ark", "arxiv", "core", "dblp", "doi", "release_ident", "work_ident", "hdl", "isbn13", "jstor", "mag", "mid", "oai", "openalex", "pii", "pmcid", "pmid", "wikidata_qid")


def tabular(df: DataFrame, kinds: tuple[str, ...] = TABULAR) -> DataFrame:
    """One flat row a release: id columns and the normalised title."""
    return df.select("id", "source", text.one_line(F.col("title")).alias("title"), text.title_key(F.col("title")).alias("title_key"), "release_year", *(F.try_element_at("extids", F.lit(k)).alias(k) for k in kinds))
