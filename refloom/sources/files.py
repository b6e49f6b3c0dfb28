"""Scans: PDF files, what their bytes hold, side files, manifests, XML headers; and how records are written."""

from __future__ import annotations

from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import find, scan_filename
from ..functions.text import clean, collapse, first_file, sections

LARGE, HEAD = 25_000_000, 20_000_000
HIT_PAGES = 3
XMP_TAGS = ("prism:doi", "dc:identifier", "prism:url")


def inventory(spark: SparkSession, folder: str, recursive: bool = False, fast: bool = False, stream: bool = False) -> DataFrame:
    """path, filename, stem, length, content of every PDF whatever the case of its suffix; ``fast`` reads the head of large ones."""
    reader = spark.readStream.schema("path string, modificationTime timestamp, length long, content binary") if stream else spark.read
    df = reader.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    content = F.when(F.col("length") > LARGE, F.substring("content", 1, HEAD)).otherwise(F.col("content")) if fast else F.col("content")
    return df.select("path", name.alias("filename"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), "length", content.alias("content"))


def decoded(content: Column) -> Column:
    """UTF-8, or else every byte as the character of its number: nothing is lost."""
    return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))


def _each(blocks: Column, source: Column) -> Column:
    return F.flatten(F.transform(blocks, lambda b, i: find(b, F.concat(source, i.cast("string")))))


def raw_hits(text: Column) -> Column:
    """Identifiers in a file's decoded bytes and, again, in each of its link annotations."""
    links = F.regexp_extract_all(text, F.lit(r"(?is)/URI\s*\((.*?)\)"), F.lit(1))
    return F.concat(find(text, F.lit("raw_pdf_bytes")), F.flatten(F.transform(links, lambda t: find(t, F.lit("pdf_uri_annotation")))))


def xmp_hits(text: Column) -> Column:
    blocks = F.regexp_extract_all(text, F.lit(r"(?is)(<x:xmpmeta\b.*?</x:xmpmeta>)"), F.lit(1))
    tags = [_each(F.regexp_extract_all(text, F.lit(rf"(?is)<{t}[^>]*>(.*?)</{t}>"), F.lit(1)), F.lit(f"xmp_tag_{t}_")) for t in XMP_TAGS]
    return F.concat(_each(blocks, F.lit("xmp_metadata_")), *tags)


def section_hits(text: Column, prefix: str = "markdown") -> Column:
    s = sections(text)
    return F.concat(*[find(s[p], F.lit(f"{prefix}_{p}"), spaced=True) for p in ("front", "body", "references")])


class TextExtractor(Protocol):
    """PDF bytes to (title, author, info text, page texts); raises or returns blanks where it cannot."""

    def __call__(self, content: bytes, pages: int) -> tuple[str, str, str, list[str]]: ...


PDF = "title string, author string, info string, pages array<string>"


def pypdf_text(content: bytes, pages: int) -> tuple[str, str, str, list[str]]:
    """By pypdf where it is installed; nothing where it is not. What was read before a failure is kept."""
    try:
        import io

        from pypdf import PdfReader
    except ImportError:
        return "", "", "", []
    title = author = info = ""
    out: list[str] = []
    try:
        reader = PdfReader(io.BytesIO(content))
        if reader.is_encrypted:
            reader.decrypt("")
        meta = {k: str(v) for k, v in dict(reader.metadata or {}).items() if v}
        title, author, info = meta.get("/Title", "").strip(), meta.get("/Author", "").strip(), " ".join(meta.values())
        out.extend(p.extract_text() or "" for p in reader.pages[:pages])
    except Exception:  # noqa: BLE001  broken files are common: they are rows with less in them
        pass
    return title, author, info, out


def pdf_text(content: Column, pages: int = 3, extractor: TextExtractor = pypdf_text) -> Column:
    @F.pandas_udf(PDF)
    def run(data: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([extractor(b, pages) if b is not None else ("", "", "", []) for b in data], columns=["title", "author", "info", "pages"])

    return run(content)


def pdf_hits(pdf: Column) -> Column:
    pages = F.flatten(F.transform(pdf["pages"], lambda t, i: find(t, F.concat(F.lit("pypdf_page_"), (i + 1).cast("string")), spaced=True)))
    return F.concat(find(pdf["info"], F.lit("pypdf_metadata")), pages)


def file_hits(files: DataFrame, extractor: TextExtractor = pypdf_text, text_pages: int = 3) -> DataFrame:
    """path, filename, title, author, page_text, text, hits: name, bytes, XMP and pages, in this order. The content goes no further.

    Identifiers are read from the first three pages; ``page_text`` is those, ``text`` the first ``text_pages``.
    """
    raw = decoded(F.col("content"))
    df = files.withColumn("pdf", pdf_text(F.col("content"), max(text_pages, HIT_PAGES), extractor)).withColumn("raw", raw)
    some = lambda c: F.nullif(clean(F.col(f"pdf.{c}")), F.lit(""))
    pages = lambda n: F.array_join(F.slice("pdf.pages", 1, n), "\n")
    front = F.col("pdf").withField("pages", F.slice("pdf.pages", 1, HIT_PAGES))
    hits = F.concat(scan_filename(F.col("stem")), raw_hits(F.col("raw")), xmp_hits(F.col("raw")), pdf_hits(front))
    return df.select("path", "filename", some("title").alias("title"), some("author").alias("author"), pages(HIT_PAGES).alias("page_text"), pages(max(1, text_pages)).alias("text"), hits.alias("hits"))


def side_texts(spark: SparkSession, folder: str) -> DataFrame:
    """name, text of Markdown files."""
    df = spark.read.text(f"{folder}/*.md", wholetext=True)
    return df.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)$", 1).alias("name"), F.col("value").alias("text"))


def with_side_text(files: DataFrame, texts: DataFrame) -> DataFrame:
    """Each file with the text of <stem>.md or else <name>.md: one join on both names, the best kept."""
    names = files.select("path", F.posexplode(F.array(F.concat("stem", F.lit(".md")), F.concat("filename", F.lit(".md")))).alias("n", "name"))
    found = names.join(texts, "name").groupBy("path").agg(F.min_by("text", "n").alias("side_text"))
    return files.join(found, "path", "left")


SIDE = ("title", "authors", "doi", "year", "journal", "publisher", "abstract")


def side_key(*columns: Column) -> Column:
    """Lower-case file name of the first path given; that of a header file is without its suffix."""
    path = first_file(*columns)
    return F.lower(F.regexp_extract(F.regexp_replace(path, r"(?:\.header)?\.tei\.xml$", ""), r"([^/]*)$", 1))


def side_table(spark: SparkSession, path: str) -> DataFrame:
    """name_key and the metadata columns of a JSON-lines or tab-separated table; the last row of a name wins."""
    if path.lower().endswith(".jsonl"):
        df = spark.read.json(path)
    else:
        df = manifest(spark, path)
    for c in (*SIDE, "source_pdf", "filename", "path", "tei_xml"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.withColumn("_n", F.monotonically_increasing_id()).withColumn("name_key", side_key(F.col("source_pdf"), F.col("filename"), F.col("path"), F.col("tei_xml")))
    if df.schema["authors"].dataType.typeName() == "array":
        df = df.withColumn("authors", F.array_join("authors", "; "))
    last = df.filter("name_key <> ''").groupBy("name_key").agg(F.max_by(F.struct(*[clean(F.col(c)).alias(c) for c in SIDE]), "_n").alias("r"))
    return last.select("name_key", "r.*")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=True, maxCharsPerColumn=-1)


def keyed(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key."""
    rest = [c for c in df.columns if c not in (*keys, order)]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def layout_text(blocks: DataFrame, key: str, max_chars: int) -> DataFrame:
    """blocks (key, page, x, y, text) -> key, text: pages under headings, blocks from top to bottom and left to right.

    A block is one paragraph of its lines; blocks of three characters or fewer, or of digits alone, are left out.
    """
    lines = F.filter(F.transform(F.split("text", r"\r\n|[\n\r]"), collapse), lambda s: s != "")
    parts = blocks.withColumn("text", F.array_join(lines, " ")).filter((F.length("text") > 3) & ~F.col("text").rlike(r"^\d+$"))
    order = F.struct(F.round("y", 1).alias("y"), F.round("x", 1).alias("x"), "text")
    pages = parts.groupBy(key, "page").agg(F.array_sort(F.collect_list(order)).alias("b"))  # a page's blocks
    shown = F.concat_ws("\n\n", F.concat(F.lit("# Page "), F.col("page").cast("string")), F.array_join(F.transform("b", lambda c: c["text"]), "\n\n"), F.lit(""))
    whole = pages.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("page", shown.alias("shown")))).alias("p"))
    return whole.select(key, F.substring(F.array_join(F.transform("p", lambda c: c["shown"]), "\n\n"), 1, max_chars).alias("text"))


def tei_header(xml: Column) -> Column:
    """struct(title, doi, date, year, journal, publisher, authors, abstract) of a header; blanks for text that is no XML.

    A Python reader of standard XML: the engine's own XPath stops the job at a malformed text.
    """

    @F.pandas_udf("title string, doi string, date string, year string, journal string, publisher string, authors string, abstract string")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_tei(t) for t in texts], columns=["title", "doi", "date", "year", "journal", "publisher", "authors", "abstract"])

    return run(xml)


def _tei(text: str | None) -> tuple[str, ...]:
    import re
    import xml.etree.ElementTree as ET

    from .tei import header

    try:
        root = ET.fromstring(re.sub(r"^\s*<\?xml[^>]*\?>", "", text or ""))
    except ET.ParseError:
        return ("",) * 8
    return header(root)


def cell(x: Column, kind: str) -> Column:
    """How a table cell shows a value: lists joined, structures as JSON, null empty."""
    if kind == "array<string>":
        return F.coalesce(F.array_join(x, "; "), F.lit(""))
    if kind.startswith(("array", "struct", "map")):
        return F.coalesce(F.to_json(x), F.lit(""))
    if kind == "boolean":
        return F.when(x, "1").otherwise("0")
    return F.coalesce(x.cast("string"), F.lit(""))


def write_table(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Tab-separated with a header and doubled quotes. Of ``columns`` those that there are not stay empty."""
    kinds = dict(df.dtypes)
    out = df.select(*[(cell(F.col(c), kinds[c]) if c in kinds else F.lit("")).alias(c) for c in columns or df.columns])
    out.write.mode("overwrite").csv(path, sep="\t", header=True, quote='"', escape='"', emptyValue="", lineSep="\n")


def write_json(df: DataFrame, path: str, order: str = "path") -> None:
    df.orderBy(order).write.mode("overwrite").option("ignoreNullFields", "true").json(path)
