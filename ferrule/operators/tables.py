"""Tables in text and HTML to rows, cells and Markdown."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.functions.arrow import each


class _Reader(HTMLParser):
    """Rows of cells of the tables of a text, and the text around them with line breaks and sub- and superscripts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[tuple[str, bool]]] = []
        self.cell: list[str] | None = None
        self.header = self.skip = False
        self.out: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.skip = True
        elif tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            self.cell, self.header = [], tag == "th"
        elif tag in ("br", "p", "div", "li", "h1", "h2", "h3"):
            self._put("\n")
        elif tag in ("sub", "sup"):
            self._put("_{" if tag == "sub" else "^{")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.skip = False
        elif tag in ("td", "th") and self.cell is not None:
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append((" ".join("".join(self.cell).split()), self.header))
            self.cell = None
        elif tag in ("sub", "sup"):
            self._put("}")
        elif tag in ("p", "div", "table"):
            self._put("\n")

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self._put(data)

    def _put(self, s: str) -> None:
        (self.out if self.cell is None else self.cell).append(s)


def _read(html: str | None) -> _Reader:
    r = _Reader()
    r.feed(html or "")
    r.close()
    return r


def html_cells(html: str | None) -> list[dict]:
    """(row, col, name, value) of each data cell: names from the header row, else col_0, col_1 and so on."""
    rows = [r for r in _read(html).rows if r]
    head = [v for v, _ in rows[0]] if rows and all(h for _, h in rows[0]) else None
    body = rows[1:] if head else rows
    return [{"row": i, "col": j, "name": head[j] if head and j < len(head) else f"col_{j}", "value": v} for i, r in enumerate(body) for j, (v, _) in enumerate(r)]


def html_markdown(html: str | None) -> str | None:
    """The text with a simple table as Markdown, its short rows filled up; null stays null."""
    if html is None:
        return None
    r = _read(html)
    rows = [[v for v, _ in row] for row in r.rows if row]
    text = "\n".join(x.strip() for x in "".join(r.out).splitlines() if x.strip())
    if not rows:
        return text
    width = max(map(len, rows))
    filled = [row + [""] * (width - len(row)) for row in rows]
    lines = ["| " + " | ".join(row) + " |" for row in filled]
    return "\n".join(filter(None, [text, lines[0], "|" + " --- |" * width, *lines[1:]]))


def merged_cells(html: Column) -> Column:
    """Whether a table has cells over several rows or columns."""
    return html.rlike(r"(?i)(row|col)span\s*=\s*[\"']?\s*([2-9]|[1-9][0-9])")


def cells_of(df: DataFrame, html: str, *keys: str) -> DataFrame:
    return df.select(*keys, F.explode(each(html_cells, "array<struct<row:int, col:int, name:string, value:string>>", html)).alias("c")).select(*keys, "c.*")


def to_markdown(html: Column | str) -> Column:
    return each(html_markdown, "string", html)


def gap_columns(text: str | None, tolerance: int = 3) -> list[list[str]] | None:
    """Rows of a plain-text table whose columns are parted by gaps: starts of cells within a tolerance are one column."""
    lines = [x for x in (text or "").splitlines() if x.strip()]
    if len(lines) < 2:
        return None
    import re

    cells = [[(m.start(), m[0].strip()) for m in re.finditer(r"\S+(?: \S+)*", x)] for x in lines]
    if sum(len(c) >= 2 for c in cells) < 2:
        return None
    columns: list[int] = []
    for at in sorted(s for c in cells for s, _ in c):
        if not columns or at - columns[-1] > tolerance:
            columns.append(at)
    out = []
    for c in cells:
        row = [""] * len(columns)
        for s, v in c:
            k = max(i for i, at in enumerate(columns) if at <= s)
            row[k] = (row[k] + " " + v).strip()
        out.append(row)
    return out


def text_rows(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """(keys, row, cells) of pipe and tab tables in a text: only rows of the most frequent width, of two cells at least."""
    lines = df.select(*keys, F.posexplode(F.split(text, "\n", -1)).alias("row", "line")).where(F.col("line").rlike(r"\||\t"))
    parts = F.transform(F.split(F.regexp_replace("line", r"^\s*\||\|\s*$", ""), r"\s*\|\s*|\t"), lambda x: F.trim(x))
    rows = lines.withColumn("cells", parts).withColumn("n", F.size("cells")).where(~F.col("line").rlike(r"^[\s|:-]+$"))
    width = rows.groupBy(*keys, "n").agg(F.count("*").alias("c")).groupBy(*keys).agg(F.max_by("n", F.struct("c", "n")).alias("n")).where("n >= 2")
    return rows.join(width, [*keys, "n"]).select(*keys, "row", "cells")
