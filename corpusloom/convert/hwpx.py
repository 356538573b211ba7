"""Text of zipped-XML documents: table rows, paragraphs and equations."""

from __future__ import annotations

import html
import io
import re
import zipfile
from xml.parsers import expat

#: Names of elements, and words that speak of formulas.
TABLE, ROW, CELL, PARAGRAPH = "tbl", "tr", "tc", "p"
EQUATIONS = frozenset(("equation", "formula", "eq"))
FORMULA_WORDS = ("equation", "formula", "수식")
LABEL = "수식: "


class ConversionError(Exception):
    """A file that cannot be converted; the message says why."""


def normal_text(text: str) -> str:
    return " ".join(html.unescape(text).split())


class Section:
    """One XML file, read in one pass over its events.

    Lines have their place from where their element begins and get their text where it ends. Tables' rows
    come before what stands outside of tables; a row inside of another table belongs to both. Hints
    count elements of tables, and elements, attributes and texts that speak of formulas.
    """

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.open: list[tuple[str, int, list, str]] = []  # name, first text, where its line goes, attributes
        self.tables: list[list] = []
        self.inside: list[list] = []  # the row lists of open tables
        self.cells: list[list] = []  # the cell lists of open rows
        self.outside: list[list[str]] = []
        self.table_hints = self.formula_hints = 0
        self.broken = False

    def read(self, data: bytes) -> Section:
        parser = expat.ParserCreate(namespace_separator="}")
        parser.buffer_text, parser.buffer_size = True, max(8192, min(len(data) + 1, 1 << 26))
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = self._start, self._end, self._text
        try:
            parser.Parse(data, True)
        except expat.ExpatError:
            self.broken = True
        return self

    def _start(self, tag: str, attributes: dict[str, str]) -> None:
        name, said, place = re.split("[}:]", tag)[-1], " ".join(attributes.values()), []
        self.table_hints += name in (TABLE, ROW, CELL)
        self.formula_hints += name == "eq" or any(w in f"{name} {' '.join(attributes)} {said}".lower() for w in FORMULA_WORDS)
        if name == TABLE:
            self.tables.append(place)
            self.inside.append(place)
        elif name == ROW:
            for rows in self.inside:
                rows.append(place)
            self.cells.append(place)
        elif name == CELL:
            for cells in self.cells:
                cells.append(place)
        elif (name == PARAGRAPH or name in EQUATIONS) and not self.inside:
            self.outside.append(place)
        self.open.append((name, len(self.texts), place, said))

    def _text(self, text: str) -> None:
        if text.strip():
            self.texts.append(text.strip())
            self.formula_hints += any(w in text.lower() for w in FORMULA_WORDS)

    def _end(self, _: str) -> None:
        name, first, place, said = self.open.pop()
        if name == TABLE:
            self.inside.pop()
        elif name == ROW:
            self.cells.pop()
        else:
            text = normal_text(" ".join(self.texts[first:]))
            if name in EQUATIONS:
                text = normal_text(f"{text} {said}")
                text = text and LABEL + text
            place.append(text)

    def lines(self) -> list[str]:
        """Rows with at least two filled cells, then the lines outside of tables; equal ones in a row are one."""
        found = []
        for table in self.tables:
            for row in table:
                filled = [cell[0] for cell in row if cell and cell[0]]
                if len(filled) > 1:
                    found.append(f"| {' | '.join(filled)} |")
        found += [line[0] for line in self.outside if line and line[0]]
        return [line for before, line in zip([None, *found], found, strict=False) if line != before]


def section_text(xml: str) -> str:
    """The text of one section. XML that cannot be read, or holds no line, gives its bare text."""
    section = Section().read(xml.encode())
    lines = [] if section.broken else section.lines()
    return "\n".join(lines) or normal_text(re.sub(r"<[^>]+>", " ", xml))


def _parts(data: bytes):
    """The XML files of an archive, in its order."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        for name in archive.namelist():
            if name.lower().endswith(".xml"):
                yield name.lower(), archive.read(name).decode("utf-8", "replace")


def hwpx_text(data: bytes) -> str:
    """The text of all body sections of a file, in the archive's order."""
    try:
        texts = [section_text(xml) for name, xml in _parts(data) if "section" in name or "bodytext" in name]
    except zipfile.BadZipFile as error:
        raise ConversionError("not a readable HWPX archive") from error
    if not any(texts):
        raise ConversionError("no readable HWPX body XML found")
    return "\n\n".join(t for t in texts if t)


def raw_hints(extension: str, data: bytes | None) -> tuple[int, int]:
    """How many hints of tables and formulas the XML of a raw file holds; (0, 0) for what cannot be read."""
    if extension != ".hwpx" or not data:
        return 0, 0
    try:
        read = [Section().read(xml.encode()) for _, xml in _parts(data)]
    except (OSError, zipfile.BadZipFile):
        return 0, 0
    return sum(s.table_hints for s in read), sum(s.formula_hints for s in read)
