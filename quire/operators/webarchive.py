"""Captured pages: full-text links, known rewrites, crawl decisions, redirect chains."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from quire.operators.relational import first_of
from quire.operators.search import first_reason, first_value
from quire.operators.sinks import stored

#: Links from pages to full texts, in order: a part of the page's address, elements by selector, the attribute that holds
#: the link, a part that the link must have, the rule's name, and whether the link is another page (fixed values).
LINKS = (
    ("elifesciences.org/articles", "a.article-download-links-list__link", "href", "", "elifesciences", False),
    ("/content/10.", "a.pdf[title=Download]", "href", "", "a.pdf_link", False),
    ("research.tue.nl", "meta[name=citation_pdf_url]", "content", "", "research.tue.nl", False),
    ("hal.science", "div.widget-files a", "href", "pdf", "hal", False),
    ("/record/", "#detailedrecordminipanelfile a", "href", "", "invenio-record", False),
    ("repositorio.unicamp.br", "span.titulo a", "href", "", "unicamp", False),
    ("ingentaconnect.com/content/", "a.pdf[data-popup]", "data-popup", "", "ingenta", False),
    ("/dlibra/", "iframe#js-main-frame", "src", "", "dlibra-iframe", False),
    ("/available/", "table.file-table a", "href", "", "unipi.it", False),
    ("/islandora/", "a.islandora-pdf-link", "href", "", "islandora", False),
    ("/registro.do", ".resumen_bib a[data-analytics=open-mediagroup]", "href", "", "digibis-media-link", False),
    ("repository.dri.ie/", "a#download_surrogate", "href", "", "dri.ie-download-link", False),
    ("/view/", "a.download", "href", "", "ojs-pdf-download", False),
    ("/view/", "a.pdf", "href", "/article/", "ojs-pdf-embed", False),
    ("scitemed.com/article/", "li.tab_pdf_btn a", "href", "", "scitemed", False),
    ("doaj.org/article/", "section.col-md-8 a.button--primary[target=_blank]", "href", "", "doaj-access-link", True),
    ("/article/view", "a.obj_galley_link.file", "href", "", "ojs-remote-pdf", True),
    ("dlib.si/details/", "body #FilesBox a", "href", "", "dlib.si", False),
    ("filclass.ru", "main .pdf-article a.pdficon", "href", "", "filclass.ru", False),
    ("linkinghub.elsevier.com/retrieve/pii", "#redirectURL", "value", "", "linkinghub", True),
    ("ieeexplore.ieee.org/stamp/stamp.jsp?arnumber", "iframe", "src", "", "ieee-iframe", False),
    ("", "meta[name=citation_pdf_url]", "content", "", "citation_pdf_url", False),
    ("", "meta[name=bepress_citation_pdf_url]", "content", "", "bepress_citation_pdf_url", False),
    ("", "meta[name=eprints.document_url]", "content", "", "eprints-document_url", False),
    ("", "embed[type=application/pdf]", "src", "", "pdf-embed-type", False),
    ("", "embed[alt=pdf]", "src", "", "pdf-embed-alt", False),
    ("", "a.downloadPdf", "href", "", "downloadPdf", False),
    ("", ".download-article a", "href", "pdf", "download-article", False),
    ("", "a.download-pdf", "href", "", "download-pdf", False),
)
#: Links that stand in scripts: a part of the page's address, a pattern, the rule's name, and whether the link is another page (fixed values).
SCRIPTS = (
    ("/article/view/", r'pdfUrl = "(.*)";', "jspdfurl", False),
    ("ieeexplore.ieee.org/document/", r'"pdfPath":"(/.*?\.pdf)"', "ieeejs", True),
)
#: Known rewrites of landing pages to full texts: what an address must match, the part that is replaced, and by what; first match wins (fixed values).
REWRITES = (
    (r"^https://arxiv\.org/pdf/.*\.pdf$", r"\.pdf$", ""),
    (r"arxiv\.org/abs/", r"^(.*?)/abs/", "$1/pdf/"),
    (r"^https://onlinelibrary\.wiley\.com/doi/", r"^(.*?)doi", "$1doi/pdf"),
    (r"protocols\.io/view/(?!.*\.pdf$)", "$", ".pdf"),
    (r"^https://journals\.sagepub\.com/doi/10\.", "$", "?download=true"),
    (r"^https://journals\.sagepub\.com/doi/pdf/10\.", "$", "?download=true"),
    (r"^https://pubs\.acs\.org/doi/10", r"^(.*?)/doi/(.*?)#?$", "$1/doi/pdf/$2?ref=article_openPDF"),
    (r"jcancer\.org/.*\.html$", r"^(.*?)\.html", "$1.pdf"),
    (r"jcancer\.org/.*\.htm$", r"^(.*?)\.htm", "$1.pdf"),
    (r"tandfonline\.com/doi/full/10\.", r"^(.*?)/doi/full/", "$1/doi/pdf/"),
    (r"isca-archive\.org.*\.html$", r"^(.*?)\.html", "$1.pdf"),
    (r"journals\.uchicago\.edu/doi/10", r"^(.*?)/doi/", "$1/doi/epdf/"),
    (r"integrityresjournals\.org/journal/JBBD/article-abstract/", r"^(.*?)/article-abstract/", "$1/article-full-text-pdf/"),
    (r"cdnsciencepub\.com/doi/10", r"^(.*?)/doi/", "$1/doi/pdf/"),
    (r"worldscientific\.com/doi/abs/", r"^(.*?)/doi/abs/(.*)$", "$1/doi/pdf/$2?download=true"),
    (r"^(?!.*/doi/pdf).*ahajournals\.org/doi/", r"^(.*?)/doi/(.*)$", "$1/doi/pdf/$2?download=true"),
    (r"^(?!.*doi/pdf).*ehp\.niehs\.nih\.gov/doi/full", r"^(.*?)/doi/full/(.*)$", "$1/doi/pdf/$2?download=true"),
    (r"^(?!.*doi/pdf).*ehp\.niehs\.nih\.gov/doi/10", r"^(.*?)/doi/(.*)$", "$1/doi/pdf/$2?download=true"),
    (r"publications\.rwth-aachen\.de/record/(?!.*\.pdf$)", r"^(.*/([^/]+))/?$", "$1/files/$2.pdf"),
    (r"^(?!.*/pdf).*\.jmir\.org", r"^(.*?)/?$", "$1/PDF"),
    (r"array\.aami\.org/doi/10\.", r"^(.*?)/doi/(.*)$", "$1/doi/pdf/$2?download=true"),
    (r"drive\.google\.com/file/d/.*/view", r"^(?:[^/]*/){5}([^/]{11,})(?:/.*)?$", "https://drive.google.com/uc?export=download&id=$1"),
)


def known_rewrite(url: Column) -> Column:
    """The address of the full text where the landing page's address tells it, else the address itself."""
    return first_value([(url.rlike(p), F.regexp_replace(url, part, by)) for p, part, by in REWRITES], url)


#: Release types that are looked for (fixed values).
PAPERLIKE = ("article-journal", "book", "paper-conference", "chapter", "report", "thesis")


def crawl_skip(release_type: Column, extids: Column, full_texts: Column, blocked: tuple[str, ...] = ()) -> Column:
    """Why a release's full text is not looked for, NULL if it is; `blocked` are prefixes of DOIs."""
    doi = F.coalesce(F.try_element_at(extids, F.lit("doi")), F.lit(""))
    cases = [("not-paperlike", ~F.coalesce(release_type, F.lit("")).isin(*PAPERLIKE)), ("no-extids", F.coalesce(F.size(extids), F.lit(0)) <= 0)]
    cases += [(f"doi-prefix-blocked:{p}", F.startswith(doi, F.lit(p))) for p in blocked]
    return first_reason([*cases, ("no-fulltext-urls", F.size(full_texts) == 0)])


#: Parts of addresses whose files are no papers (fixed values).
IGNORED = ("wiley.com/action/downloadSupplement",)


def wanted_captures(captures: DataFrame, cursed: DataFrame, ignored: tuple[str, ...] = IGNORED) -> DataFrame:
    """captures (sha1_b32, url, ...) with `skip`: cursed for listed digests (sha1_b32), ignored for parts of addresses, else NULL."""
    marked = captures.join(F.broadcast(cursed.select("sha1_b32").distinct().withColumn("__cursed", F.lit(True))), "sha1_b32", "left")  # a short list, kept by hand
    part = F.lit(False)
    for p in ignored:
        part = part | F.coalesce(F.contains("url", F.lit(p)), F.lit(False))
    return marked.select(*captures.columns, F.when(F.col("__cursed"), "cursed").when(part, "ignored").alias("skip"))


def unseen(captures: DataFrame, files: DataFrame, *order: Column | str) -> DataFrame:
    """Captures (sha1_hex, url, ...) whose file is not held yet, the first of each by `order`, so that only these are fetched; files have sha1. Captures without a digest are left out."""
    new = captures.where("sha1_hex IS NOT NULL").join(files.select(F.col("sha1").alias("sha1_hex")), "sha1_hex", "left_anti")
    return first_of(new, "sha1_hex", [F.col(x) if isinstance(x, str) else x for x in order]).select(*captures.columns)


def capture_counts(urls: DataFrame, captures: DataFrame) -> DataFrame:
    """(url, count) of captures for each distinct address asked for, zero included."""
    n = captures.groupBy("url").agg(F.count("*").alias("count"))
    return urls.select("url").distinct().join(n, "url", "left").select("url", F.coalesce("count", F.lit(0)).alias("count"))


def is_html(mimetype: Column) -> Column:
    return F.coalesce(F.lower(mimetype).rlike("/html|/xhtml|application/xml|text/xml"), F.lit(False))


class Page:
    """The elements of a page in order, each with its tag, attributes and parent."""

    EMPTY = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")

    def __init__(self, html: str):
        from html.parser import HTMLParser

        found, open_ = [], []

        class Reader(HTMLParser):
            def handle_starttag(self, tag, attrs):
                found.append((tag, dict(attrs), open_[-1] if open_ else -1))
                if tag not in Page.EMPTY:
                    open_.append(len(found) - 1)

            def handle_startendtag(self, tag, attrs):
                found.append((tag, dict(attrs), open_[-1] if open_ else -1))

            def handle_endtag(self, tag):
                for k in range(len(open_) - 1, -1, -1):
                    if found[open_[k]][0] == tag:
                        del open_[k:]
                        break

        reader = Reader()
        reader.feed(html)
        reader.close()
        self.found = found

    def has(self, k: int, simple: str) -> bool:
        """Whether element k meets tag#id.class[attribute=value]."""
        tag, attrs, _ = self.found[k]
        m = re.fullmatch(r"([a-z]*)(?:#([\w-]+))?((?:\.[\w-]+)*)(?:\[([\w-]+)(?:=([^\]]*))?\])?", simple)
        name, own, classes, key, value = m.groups()
        mine = (attrs.get("class") or "").split()
        return (not name or name == tag) and (not own or attrs.get("id") == own) and all(c in mine for c in classes.split(".")[1:]) and (not key or key in attrs and (value is None or attrs[key] == value))

    def first(self, selector: str) -> dict | None:
        """Attributes of the first element that meets the last part of the selector, and whose ancestors meet the others."""
        *above, last = selector.split()
        for k in range(len(self.found)):
            if self.has(k, last):
                left, up = list(above), self.found[k][2]
                while left and up >= 0:
                    if self.has(up, left[-1]):
                        left.pop()
                    up = self.found[up][2]
                if not left:
                    return self.found[k][1]
        return None

    def second_noscript_link(self) -> str | None:
        place = [k for k, (tag, _, _) in enumerate(self.found) if tag == "noscript"]
        for tag, attrs, up in self.found if len(place) > 1 else ():
            while up >= 0 and up != place[1]:
                up = self.found[up][2]
            if tag == "a" and up >= 0:
                return attrs.get("href")
        return None


def next_link(html: str, url: str) -> tuple[str | None, str | None, bool]:
    """(link, rule, whether it is another page) by the first rule that applies."""
    from urllib.parse import unquote, urljoin, urlsplit, urlunsplit

    for part, pattern, rule, hop in SCRIPTS:
        m = re.search(pattern, html) if part in url else None
        if m:
            return urljoin(url, m[1].replace("\\", "") if rule == "jspdfurl" else m[1]), rule, hop
    page = Page(html)
    for part, selector, attribute, needs, rule, hop in LINKS:
        if rule == "digibis-media-link" and "/receive/" in url and page.second_noscript_link():
            return urljoin(url, page.second_noscript_link()), "mycore-receive", False
        if rule == "ieee-iframe" and "sciengine.com/" in url:
            issn, article = ((page.first(f"meta[name={k}]") or {}).get("content") for k in ("citation_issn", "citation_id"))
            if issn and article:
                return f"https://www.sciengine.com/cfs/files/pdfs/view/{issn}/{article}.pdf", "sciengine", False
        if part not in url:
            continue
        link = (page.first(selector) or {}).get(attribute)
        if link is None or needs not in link:
            continue
        if rule == "research.tue.nl":
            link = link.replace("research.tue.nl", "pure.tue.nl", 1).replace("/files/", "/ws/portalfiles/portal/", 1)
        if rule == "linkinghub":
            link = unquote(link)
            link = urlunsplit(urlsplit(link)._replace(query="")) if "?via" in link else link
        return urljoin(url, link), rule, hop
    return None, None, False


@F.pandas_udf(StructType([StructField("url", StringType()), StructField("rule", StringType()), StructField("hop", BooleanType())]))
def full_text_link(html: pd.Series, base: pd.Series) -> pd.DataFrame:
    """struct(url, rule, hop): the full-text link of a page, made absolute; hop says that it is another page to look at."""
    return pd.DataFrame([next_link(p or "", u or "") for p, u in zip(html, base, strict=True)], columns=["url", "rule", "hop"])


def registered_domains(df: DataFrame, host: str, rules: DataFrame, name: str = "domain") -> DataFrame:
    """df with the registered domain of each host: one label more than the longest public suffix that a rule (one column `rule`) names.

    Rules are as public suffix lists write them: `co.uk`, `*.ck` for every label below, `!www.ck` for an exception to that; a host that none
    names has its last label as suffix.  Each host's own suffixes are looked up in the rules by an equi-join over the distinct hosts.  Ports do
    not count; a host that is a suffix itself, an address of numbers, or none has no registered domain.
    """
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.col(host)), r":\d*$", ""), r"\.$", "")
    hosts = df.select(F.col(host).alias("__h"), F.split(bare, r"\.").alias("__l")).where("__h IS NOT NULL").distinct()
    ends = hosts.select("__h", "__l", F.explode(F.sequence(F.lit(1), F.size("__l"))).alias("__n"))
    tail = lambda n: F.array_join(F.slice("__l", F.size("__l") - n + 1, n), ".")
    keys = ends.select("__h", "__n", F.explode(F.array(F.struct(tail(F.col("__n")).alias("k"), F.col("__n").alias("labels"), F.lit(0).alias("rank")), F.struct(F.concat(F.lit("!"), tail(F.col("__n"))).alias("k"), (F.col("__n") - 1).alias("labels"), F.lit(1).alias("rank")),
        F.struct(F.when(F.col("__n") > 1, F.concat(F.lit("*."), tail(F.col("__n") - 1))).alias("k"), F.col("__n").alias("labels"), F.lit(0).alias("rank")))).alias("x")).select("__h", F.col("x.k").alias("rule"), "x.labels", "x.rank")
    best = keys.join(rules.select(F.lower(F.trim("rule")).alias("rule")).distinct(), "rule").groupBy("__h").agg(F.max_by("labels", F.struct("rank", "labels")).alias("suffix"))
    own = hosts.join(best, "__h", "left").withColumn("suffix", F.coalesce("suffix", F.lit(1)))
    numbers = F.array_join("__l", ".").rlike(r"^\d+(\.\d+){3}$|:")
    good = (F.size("__l") > F.col("suffix")) & ~numbers & ~F.exists("__l", lambda x: x == "")
    domains = own.select("__h", F.when(good, F.array_join(F.slice("__l", F.size("__l") - F.col("suffix"), F.col("suffix") + 1), ".")).alias(name))
    return df.join(domains, F.col(host) == F.col("__h"), "left").drop("__h")


def hops(starts: DataFrame, links: DataFrame, most: int = 8) -> DataFrame:
    """(start, url, hop, outcome) after following captured links (url, next) for at most `most` steps.

    One join a step over what is still open, which is stored, so that no step does those before it again; a chain ends at a
    page without a link, or where it returns to itself.
    """
    links = links.select("url", "next").dropDuplicates(["url"])
    open_ = starts.select(F.col("url").alias("start"), "url", F.lit(0).alias("hop"), F.array("url").alias("seen"))
    done = None
    for step in range(most + 1):
        x = stored(open_.join(links, "url", "left"))
        loop = F.array_contains("seen", F.col("next"))
        end = F.when(F.col("next").isNull(), "end").when(loop, "loop").when(F.lit(step == most), "too-many-hops")
        ended = x.withColumn("outcome", end).where("outcome IS NOT NULL").select("start", "url", "hop", "outcome")
        done = ended if done is None else done.unionByName(ended)
        open_ = x.where(F.col("next").isNotNull() & ~loop).select("start", F.col("next").alias("url"), (F.col("hop") + 1).alias("hop"), F.concat("seen", F.array("next")).alias("seen"))
    return done
