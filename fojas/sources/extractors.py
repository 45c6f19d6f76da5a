"""Plug-in point for whatever turns a PDF into text: engines are optional and load once per Python worker."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class TextExtractor(Protocol):
    """name is the method's name; pages(content) gives the text of each page."""

    name: str

    def pages(self, content: bytes) -> list[str]: ...


_MAKERS: dict[str, object] = {}
_LOADED: dict[str, TextExtractor] = {}


def register_extractor(name: str, maker) -> None:
    """maker() builds the engine on first use in a worker; it must be importable there."""
    _MAKERS[name] = maker


def extract_texts(files: DataFrame, makers: dict | None = None) -> DataFrame:
    """(nombre_archivo, metodo, pagina, texto, error) of files (nombre_archivo, content) by every engine. A file that an engine fails on gives one row with its error (SNK11), and the job goes on."""
    chosen = dict(makers or _MAKERS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for name, maker in chosen.items():
                if name not in _LOADED:
                    _LOADED[name] = maker()
                for f, content in zip(b["nombre_archivo"], b["content"]):
                    try:
                        out += [(f, name, i + 1, t, None) for i, t in enumerate(_LOADED[name].pages(bytes(content)))]
                    except Exception as e:  # noqa: BLE001
                        out.append((f, name, 0, None, f"{type(e).__name__}: {e}"[:500]))
            yield pd.DataFrame(out, columns=["nombre_archivo", "metodo", "pagina", "texto", "error"])

    return files.select("nombre_archivo", "content").mapInPandas(run, "nombre_archivo string, metodo string, pagina int, texto string, error string")
