"""A reader of plain PDF files: pages, text with its places, sizes of images. No engine, no rasterising.

Reads indirect objects and object streams, unfiltered and Flate streams, text operators with literal and hexadecimal
strings, and ToUnicode tables. Encrypted files raise ValueError; fonts without table are read as Latin-1.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fojas.operators.register import document_kind, mean_resolution, quality

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj\b", re.S)
_STREAM = re.compile(rb"\bstream\r?\n(.*?)\r?\n?endstream", re.S)
_REF = re.compile(rb"(\d+)\s+\d+\s+R\b")
_TOKEN = re.compile(rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/\[\]()<>]+|[-+]?\d*\.?\d+|[A-Za-z'\"*]+", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
#: Share of a page's larger side within which two pieces of text stand on one line.
SAME_LINE = 0.004


@dataclass
class Page:
    """Pieces of text (x, y from the top, text), size in points, images as (width, height) in pixels."""

    pieces: list[tuple[float, float, str]] = field(default_factory=list)
    width: float = 612.0
    height: float = 792.0
    images: list[tuple[int, int]] = field(default_factory=list)

    def text(self, mode: str = "plain") -> str:
        """plain: as the file has it, a line for each new height; blocks: lines from top to bottom and left to right; layout: every piece by itself."""
        if mode not in ("plain", "blocks", "layout"):
            raise ValueError(f"no mode {mode}")
        if mode == "layout":
            return "\n".join(t.strip() for _, _, t in self.pieces if t.strip())
        pieces = sorted(self.pieces, key=lambda p: (round(p[1]), p[0])) if mode == "blocks" else self.pieces
        lines: list[list[str]] = []
        before = None
        for _, y, t in pieces:
            if before is None or abs(y - before) > SAME_LINE * max(self.width, self.height):
                lines.append([])
            lines[-1].append(t)
            before = y
        return "\n".join(s for s in (" ".join(x).strip() for x in lines) if s)

    def resolutions(self) -> list[float]:
        """Pixels per inch of each image if it fills the page, mean of both directions."""
        return [(w * 72 / self.width + h * 72 / self.height) / 2 for w, h in self.images if w and h]


class Pdf:
    def __init__(self, content: bytes):
        if not content.lstrip()[:5].startswith(b"%PDF"):
            raise ValueError("no PDF")
        if re.search(rb"/Encrypt\s+\d+\s+\d+\s+R", content):
            raise ValueError("encrypted PDF")
        self.objects: dict[int, bytes] = {int(m[1]): m[2] for m in _OBJECT.finditer(content)}
        for body in list(self.objects.values()):
            if re.search(rb"/Type\s*/ObjStm\b", body):
                self.unpack(body)

    def unpack(self, body: bytes) -> None:
        """Objects of an object stream."""
        data = self.stream(body)
        first, n = self.number(body, b"First"), self.number(body, b"N")
        head = list(map(int, data[:first].split()))[: 2 * n]
        places = list(zip(head[::2], head[1::2]))
        for k, (name, at) in enumerate(places):
            end = places[k + 1][1] if k + 1 < len(places) else len(data) - first
            self.objects.setdefault(name, data[first + at : first + end])

    @staticmethod
    def number(body: bytes, key: bytes) -> int:
        m = re.search(rb"/" + key + rb"\s+(\d+)", body)
        return int(m[1]) if m else 0

    @staticmethod
    def stream(body: bytes) -> bytes:
        m = _STREAM.search(body)
        if not m:
            return b""
        if b"/FlateDecode" not in body[: m.start()]:
            return m[1] if b"/Filter" not in body[: m.start()] else b""
        return zlib.decompressobj().decompress(m[1])

    def refs(self, body: bytes, key: bytes) -> list[int]:
        m = re.search(rb"/" + key + rb"\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", body)
        return [int(x) for x in _REF.findall(m[1])] if m else []

    def page_objects(self, body: bytes | None = None, seen: frozenset = frozenset()) -> Iterator[bytes]:
        """Bodies of the pages in reading order; entries a page lacks are taken from above it."""
        if body is None:
            root = next((b for b in self.objects.values() if re.search(rb"/Type\s*/Catalog\b", b)), b"")
            top = self.refs(root, b"Pages")
            if not top or top[0] not in self.objects:
                yield from (b for _, b in sorted(self.objects.items()) if re.search(rb"/Type\s*/Page\b", b))
                return
            yield from self.page_objects(self.objects[top[0]], frozenset(top[:1]))
            return
        for k in self.refs(body, b"Kids"):
            kid = self.objects.get(k)
            if kid is None or k in seen:
                continue
            for key in (b"MediaBox", b"Resources"):
                if b"/" + key not in kid and (m := re.search(rb"/" + key + rb"\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", body)):
                    kid = kid + b" /" + key + b" " + m[1]
            if re.search(rb"/Type\s*/Pages\b", kid):
                yield from self.page_objects(kid, seen | {k})
            else:
                yield kid

    def resources(self, page: bytes) -> bytes:
        at = self.refs(page, b"Resources")
        return self.objects.get(at[0], b"") if at else page

    def named(self, resources: bytes, kind: bytes) -> dict[bytes, int]:
        """Names of a kind of resource with the objects they stand for."""
        m = re.search(rb"/" + kind + rb"\s*(?:<<(.*?)>>|(\d+)\s+\d+\s+R)", resources, re.S)
        if not m:
            return {}
        inside = m[1] if m[1] is not None else self.objects.get(int(m[2]), b"")
        return {name: int(k) for name, k in re.findall(rb"/([^\s/<>]+)\s+(\d+)\s+\d+\s+R", inside)}

    def unicode_table(self, font: int) -> dict[int, str] | None:
        """Code -> text of a font's ToUnicode stream."""
        at = self.refs(self.objects.get(font, b""), b"ToUnicode")
        data = self.stream(self.objects.get(at[0], b"")) if at else b""
        if not data:
            return None
        table: dict[int, str] = {}
        text = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "ignore")
        for part in re.findall(rb"beginbfchar(.*?)endbfchar", data, re.S):
            table.update({int(a, 16): text(b) for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", part)})
        for part in re.findall(rb"beginbfrange(.*?)endbfrange", data, re.S):
            for a, b, c in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", part):
                start = text(c)
                for code in range(int(a, 16), min(int(b, 16), int(a, 16) + 65535) + 1):
                    table[code] = start[:-1] + chr(ord(start[-1]) + code - int(a, 16)) if start else ""
        return table

    def pages(self) -> list[Page]:
        out = []
        for body in self.page_objects():
            page = Page()
            box = re.search(rb"/MediaBox\s*\[\s*([-\d.]+)\s+([-\d.]+)\s+([-\d.]+)\s+([-\d.]+)", body)
            if box:
                x0, y0, x1, y1 = map(float, box.groups())
                page.width, page.height = abs(x1 - x0) or 612.0, abs(y1 - y0) or 792.0
            resources = self.resources(body)
            for k in self.named(resources, b"XObject").values():
                if re.search(rb"/Subtype\s*/Image\b", self.objects.get(k, b"")):
                    page.images.append((self.number(self.objects[k], b"Width"), self.number(self.objects[k], b"Height")))
            fonts = {name: self.unicode_table(k) for name, k in self.named(resources, b"Font").items()}
            content = b"\n".join(self.stream(self.objects.get(k, b"")) for k in self.refs(body, b"Contents"))
            page.pieces = [(x, page.height - y, t) for x, y, t in text_pieces(content, fonts)]
            out.append(page)
        return out


def literal(token: bytes) -> bytes:
    """Bytes of a string token."""
    if token[:1] == b"<":
        h = re.sub(rb"\s", b"", token[1:-1])
        return bytes.fromhex((h + b"0" * (len(h) % 2)).decode())
    body = re.sub(rb"\\\r?\n", b"", token[1:-1])
    return re.sub(rb"\\([0-7]{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1].isdigit() else _ESCAPES.get(m[1], m[1]), body, flags=re.S)


def decoded(data: bytes, table: dict[int, str] | None, wide: bool) -> str:
    if table is None:
        return data.decode("latin-1")
    codes = [int.from_bytes(data[i : i + 2], "big") for i in range(0, len(data) - 1, 2)] if wide else data
    return "".join(table.get(c, "") for c in codes)


def text_pieces(content: bytes, fonts: dict[bytes, dict[int, str] | None]) -> Iterator[tuple[float, float, str]]:
    """(x, y, text) of the strings that a content stream shows, at the places that its text operators set."""
    stack: list[bytes] = []
    x = y = left = leading = 0.0
    table, wide = None, False

    def numbers(n: int) -> list[float]:
        return [float(t) for t in stack[-n:]] if len(stack) >= n else [0.0] * n

    for token in _TOKEN.findall(content):
        if not re.fullmatch(rb"[A-Za-z'\"*]+", token):
            stack.append(token)
            continue
        try:
            if token == b"BT":
                x = y = left = 0.0
            elif token == b"Tf" and len(stack) >= 2:
                table = fonts.get(stack[-2][1:])
                wide = table is not None and max(table, default=0) > 255
            elif token == b"TL":
                leading = numbers(1)[0]
            elif token in (b"Td", b"TD"):
                dx, dy = numbers(2)
                leading = -dy if token == b"TD" else leading
                left, y = left + dx, y + dy
                x = left
            elif token == b"Tm":
                left, y = numbers(2)
                x = left
            elif token in (b"T*", b"'", b'"'):
                x, y = left, y - leading
            if token in (b"Tj", b"'", b'"') and stack and stack[-1][:1] in b"(<":
                yield x, y, decoded(literal(stack[-1]), table, wide)
            elif token == b"TJ":
                begin = len(stack) - 1 - stack[::-1].index(b"[") if b"[" in stack else 0
                out = ""
                for t in stack[begin:]:
                    if t[:1] in b"(<":
                        out += decoded(literal(t), table, wide)
                    elif re.fullmatch(rb"[-+]?\d*\.?\d+", t) and float(t) < -200 and not out.endswith(" "):
                        out += " "
                yield x, y, out
        except ValueError:
            pass
        stack.clear()


class NativeText:
    """Extractor of the text that a PDF holds itself, for extract_texts."""

    name = "nativo"

    def __init__(self, mode: str = "blocks"):
        self.mode = mode

    def pages(self, content: bytes) -> list[str]:
        return [p.text(self.mode) for p in Pdf(content).pages()]


def pdf_metadata(files: DataFrame) -> DataFrame:
    """(nombre_archivo, tamano_bytes, numero_paginas, tipo_documento, resolucion_ppi, calidad_estimativa, error) of files (nombre_archivo, content): from the first page its characters and the mean resolution of its images (PDF2, AGG9). A file that can't be read has its error and nulls."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for name, content in zip(b["nombre_archivo"], b["content"]):
                try:
                    pages = Pdf(bytes(content)).pages()
                    first = pages[0]
                    out.append((name, len(content), len(pages), len(first.text().strip()), first.resolutions(), None))
                except Exception as e:  # noqa: BLE001
                    out.append((name, None if content is None else len(content), None, None, None, f"{type(e).__name__}: {e}"[:500]))
            yield pd.DataFrame(out, columns=["nombre_archivo", "bytes", "n", "chars", "ppi", "error"])

    read = files.select("nombre_archivo", "content").mapInPandas(run, "nombre_archivo string, bytes long, n int, chars int, ppi array<double>, error string")
    ppi = F.when(F.col("error").isNull(), mean_resolution(F.col("ppi")))
    return read.select(
        "nombre_archivo", F.col("bytes").alias("tamano_bytes"), F.col("n").alias("numero_paginas"), F.when(F.col("chars").isNotNull(), document_kind(F.col("chars"))).alias("tipo_documento"),
        ppi.alias("resolucion_ppi"), F.when(F.col("error").isNull(), quality(ppi)).alias("calidad_estimativa"), "error",
    )
