"""Live sources. Nothing here runs unless asked for: plans read kept answers, and only what those lack comes here."""

from __future__ import annotations

import json
import subprocess
import tempfile
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

# Public addresses by source; {} is the quoted identifier or title.
ADDRESSES = {
    "doi.org": "https://doi.org/{}",
    "crossref": "https://api.crossref.org/works/{}",
    "datacite": "https://api.datacite.org/dois/{}",
    "osti": "https://www.osti.gov/api/v1/records?doi={}",
    "osti_record": "https://www.osti.gov/api/v1/records/{}",
    "crossref_title": "https://api.crossref.org/works?query.title={}&rows=5",
    "crossref_bibliographic": "https://api.crossref.org/works?query.bibliographic={}&rows=8",
    "datacite_title": "https://api.datacite.org/dois?query={}&page[size]=5",
    "openalex": "https://api.openalex.org/works?search={}&per-page=8",
    "semantic_scholar": "https://api.semanticscholar.org/graph/v1/paper/search?query={}&limit=8&fields=title,authors,year,venue,externalIds,publicationTypes",
}


@dataclass(frozen=True)
class HttpSource:
    """A JSON source by one of the addresses above; mail is told to the source as contact."""

    source: str
    timeout: float = 20
    mail: str = ""

    def agent(self) -> str:
        return "refloom/1.0" + (f" (mailto:{self.mail})" if self.mail else "")

    def fetch(self, key: str) -> str:
        headers = {"User-Agent": self.agent(), "Accept": "application/vnd.citationstyles.csl+json" if self.source == "doi.org" else "application/json"}
        request = urllib.request.Request(ADDRESSES[self.source].format(urllib.parse.quote(key, safe="")), headers=headers)
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return answer.read().decode("utf-8", "replace")


@dataclass(frozen=True)
class ChatSource:
    """A chat service: the key is the prompt. Address, model and secret come from the caller's environment."""

    address: str
    model: str
    secret: str = ""
    timeout: float = 120
    source: str = "llm"

    def fetch(self, key: str) -> str:
        body = json.dumps({"model": self.model, "temperature": 0, "messages": [{"role": "user", "content": key}]}).encode()
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.secret}"} if self.secret else {})
        with urllib.request.urlopen(urllib.request.Request(self.address.rstrip("/") + "/chat/completions", body, headers), timeout=self.timeout) as answer:
            return json.loads(answer.read())["choices"][0]["message"]["content"]


@dataclass(frozen=True)
class HeaderService:
    """A service that reads the header of a PDF and answers with TEI."""

    address: str
    timeout: float = 180

    def read(self, content: bytes, name: str) -> str:
        mark = "refloomformpart"
        body = b"".join([f'--{mark}\r\nContent-Disposition: form-data; name="input"; filename="{name}"\r\nContent-Type: application/pdf\r\n\r\n'.encode(), content, f"\r\n--{mark}--\r\n".encode()])
        headers = {"Content-Type": f"multipart/form-data; boundary={mark}", "Accept": "application/xml"}
        with urllib.request.urlopen(urllib.request.Request(self.address.rstrip("/") + "/api/processHeaderDocument", body, headers), timeout=self.timeout) as answer:
            return answer.read().decode("utf-8", "replace")


class Reader(Protocol):
    """The text of a PDF's first pages; raises where it cannot."""

    def read(self, content: bytes, name: str) -> str: ...


@dataclass(frozen=True)
class CommandLineOcr:
    """Pages drawn by Ghostscript and read by Tesseract, where both are installed."""

    pages: int = 3
    dpi: int = 250
    language: str = "eng"
    timeout: float = 120

    def read(self, content: bytes, name: str) -> str:
        with tempfile.TemporaryDirectory() as d:
            (Path(d) / "in.pdf").write_bytes(content)
            subprocess.run(["gs", "-q", "-dNOPAUSE", "-dBATCH", "-dSAFER", "-sDEVICE=png16m", f"-r{self.dpi}", "-dFirstPage=1", f"-dLastPage={self.pages}",
                f"-sOutputFile={d}/%03d.png", f"{d}/in.pdf"],
                check=True, timeout=self.timeout, capture_output=True)
            read = [subprocess.run(["tesseract", str(p), "stdout", "-l", self.language], check=True, timeout=self.timeout, capture_output=True).stdout.decode("utf-8",
                "replace") for p in sorted(Path(d).glob("*.png"))]
        return "\n".join(read)


def read_files(files: DataFrame, reader: Reader) -> DataFrame:
    """files (path, filename, content) -> path, read, error. Filter to the rows that need it first: every row is read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, name, content in zip(b["path"], b["filename"], b["content"], strict=True):
                try:
                    rows.append((path, reader.read(content, name), None))
                except Exception as e:  # noqa: BLE001  an unreadable file is a row with its error
                    rows.append((path, None, str(e)))
            yield pd.DataFrame(rows, columns=["path", "read", "error"])

    return files.select("path", "filename", "content").mapInPandas(run, "path string, read string, error string")


@dataclass(frozen=True)
class LibraryOcr:
    """Pages drawn by PyMuPDF and read by pytesseract, where both are installed; else, or where that fails, the command line."""

    pages: int = 3
    dpi: int = 250
    language: str = "eng"

    def read(self, content: bytes, name: str) -> str:
        plain = CommandLineOcr(self.pages, max(self.dpi, 300), self.language)
        try:
            import fitz
            import pytesseract
            from PIL import Image
        except ImportError:
            return plain.read(content, name)
        try:
            with fitz.open(stream=content, filetype="pdf") as doc:
                drawn = [doc[i].get_pixmap(dpi=self.dpi, alpha=False) for i in range(min(self.pages, len(doc)))]
            return "\n".join(pytesseract.image_to_string(Image.frombytes("RGB", [p.width, p.height], p.samples), lang=self.language) for p in drawn)
        except Exception:  # noqa: BLE001  another engine may read what this one cannot
            return plain.read(content, name)


@dataclass(frozen=True)
class Thumbnail:
    """The first page as a PNG, in text form (base64), drawn by PyMuPDF."""

    dpi: int = 110

    def read(self, content: bytes, name: str) -> str:
        import base64

        import fitz

        with fitz.open(stream=content, filetype="pdf") as doc:
            if not len(doc):
                raise ValueError("empty PDF")
            return base64.b64encode(doc[0].get_pixmap(dpi=self.dpi, alpha=False).tobytes("png")).decode()


@dataclass(frozen=True)
class LayoutBlocks:
    """Text blocks with their places, as JSON lines of page, x, y and text, drawn by PyMuPDF."""

    pages: int = 6

    def read(self, content: bytes, name: str) -> str:
        import fitz

        with fitz.open(stream=content, filetype="pdf") as doc:
            found = [(i + 1, *b) for i in range(min(max(1, self.pages), len(doc))) for b in doc[i].get_text("blocks")]
        return "\n".join(json.dumps({"page": b[0], "x": b[1], "y": b[2], "text": b[5]}) for b in found)
