"""A Python data source over the saved answers of a portal: items of its tree, pages and files.

A replay folder holds ``tree/<node>.json`` (a node's children), ``home.html``, ``rules/<book id>.html``,
``notices/<id>.html``, ``files/<server file>`` and ``english/<book id>/<file name>``, a rule's English text. Nothing is fetched from a network. A live client would
fill such a folder first, so that a lost task never asks a server twice.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_SCHEMAS = {
    "items": "id string, title string, document_type string, category string, book_id string, noformyn string, menu_id string, published_date string, effective_date string, state_history_id string, ord long",
    "pages": "document_type string, id string, html string",
    "files": "server_file string, content binary",
    "english": "id string, file_name string, content binary",
}


def _date(raw: object) -> str:
    found = re.search(r"([0-9]{4})\s*[.\-/]\s*([0-9]{1,2})\s*[.\-/]\s*([0-9]{1,2})", str(raw or ""))
    return "-".join([found[1], found[2].zfill(2), found[3].zfill(2)]) if found else ""


def walk(folder: str, node: str = "0", above: tuple[str, ...] = (), limit: int = 0) -> Iterator[tuple]:
    """The leaves of the tree depth-first, at most ``limit`` of them (0: all); a node without a file is a leaf."""
    left = limit

    def visit(name: str, parents: tuple[str, ...]) -> Iterator[tuple]:
        nonlocal left
        path = os.path.join(folder, "tree", f"{name}.json")
        if not os.path.exists(path):
            return
        with open(path, encoding="utf-8") as file:
            children = json.load(file)
        for child in children:
            text = lambda key, child=child: str(child.get(key) or "").strip()
            title = text("title") or text("text")
            if child.get("leaf") and int(child.get("bookid") or 0) > 0:
                yield (text("bookid"), title, "rule", " / ".join(parents), text("bookid"), text("noformyn") or "N", "", _date(text("promuldt")), _date(text("startdt")), text("statehistoryid"))
                left -= 1
                if limit and left <= 0:
                    return
            else:
                yield from visit(str(child.get("id")), (*parents, title))
                if limit and left <= 0:
                    return

    for i, row in enumerate(visit(node, above)):
        yield (*row, i)


class _Part(InputPartition):
    def __init__(self, names: list[tuple[str, str]]):
        self.names = names


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.what = options.get("what", "items")
        self.limit = int(options.get("limit", "0"))
        self.each = int(options.get("files_per_partition", "64"))

    def partitions(self) -> list[InputPartition]:
        if self.what == "items":
            return [_Part([])]  # one polite session walks the tree
        if self.what == "english":
            base = os.path.join(self.folder, "english")
            books = sorted(os.listdir(base)) if os.path.isdir(base) else []
            names = [(book, os.path.join(base, book, sorted(os.listdir(os.path.join(base, book)))[0])) for book in books if os.listdir(os.path.join(base, book))]
            return [_Part(names[i : i + self.each]) for i in range(0, len(names), self.each)] or [_Part([])]
        kinds = {"rules": "rule", "notices": "notice"} if self.what == "pages" else {"files": ""}
        names = [(kind, os.path.join(self.folder, sub, name)) for sub, kind in kinds.items() if os.path.isdir(os.path.join(self.folder, sub)) for name in sorted(os.listdir(os.path.join(self.folder, sub)))]
        if self.what == "pages" and os.path.exists(os.path.join(self.folder, "home.html")):
            names.append(("home", os.path.join(self.folder, "home.html")))
        return [_Part(names[i : i + self.each]) for i in range(0, len(names), self.each)] or [_Part([])]

    def read(self, partition: _Part) -> Iterator[tuple]:
        if self.what == "items":
            yield from walk(self.folder, limit=self.limit)
            return
        for kind, path in partition.names:
            with open(path, "rb") as file:
                data = file.read()
            name = os.path.basename(path)
            if self.what == "english":
                yield kind, name, data
                continue
            yield (name, data) if self.what == "files" else (kind, os.path.splitext(name)[0], data.decode("utf-8", "replace"))


class PortalReplay(DataSource):
    """``spark.read.format("portal_replay").option("what", "items" | "pages" | "files" | "english").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "portal_replay"

    def schema(self) -> str:
        return _SCHEMAS[self.options.get("what", "items")]

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)
