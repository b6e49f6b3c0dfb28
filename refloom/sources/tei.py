"""Fields of a TEI header."""

from __future__ import annotations

import xml.etree.ElementTree as ET


def _name(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def _text(e: ET.Element | None) -> str:
    return " ".join("".join(e.itertext()).split()) if e is not None else ""


def _under(e: ET.Element, *path: str) -> list[ET.Element]:
    """Elements by a path of names, each anywhere below the one before."""
    found = [e]
    for name in path:
        found = [x for f in found for x in f.iter() if x is not f and _name(x) == name]
    return list(dict.fromkeys(found))


def _first(root: ET.Element, *paths: tuple[str, ...]) -> str:
    return next((t for p in paths for e in _under(root, *p) if (t := _text(e))), "")


def header(root: ET.Element) -> tuple[str, ...]:
    """title, doi, date, year, journal, publisher, authors, abstract."""
    title = _first(root, ("titleStmt", "title"), ("analytic", "title"), ("monogr", "title"))
    doi = next((_text(e) for e in _under(root, "idno") if e.get("type", "").lower() == "doi" and _text(e)), "")
    dates = [e for path in (("imprint", "date"), ("publicationStmt", "date")) for e in _under(root, *path)]
    date = next((v for e in dates if (v := (e.get("when") or _text(e)).strip())), "")
    people = []
    for a in _under(root, "analytic", "author") or _under(root, "author"):
        who = " ".join(t for n in ("forename", "surname") for e in _under(a, n) if (t := _text(e))) or _text(next(iter(_under(a, "persName")), None))
        if who:
            people.append(who)
    return title, doi, date, date[:4] if date[:4].isdigit() else "", _first(root, ("monogr", "title")), _first(root, ("publicationStmt", "publisher"),
        ("imprint", "publisher")), "; ".join(people), _first(root, ("abstract",))
