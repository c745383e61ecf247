"""HTML source: pages to blocks in reading order (headings, paragraphs, list items, tables), by the standard parser."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEADINGS = {f"h{i}": i for i in range(1, 7)} | {"summary": 3}
SKIPPED = {"script", "style", "nav", "form", "noscript"}
WIDEST = 1000  # the widest span of columns that HTML allows
CELLS = "page_id long, tbl long, pos long, r int, c int, rs int, cs int, text string, header boolean"


def _span(value: str | None) -> int:
    """A span attribute as a number; what is no positive number counts as 1."""
    return max(1, int(value)) if value and value.strip().isascii() and value.strip().isdigit() else 1


def placed(rows: list[list[tuple[str, int, int, bool]]]) -> list[tuple[int, int, int, int, str, bool]]:
    """(r, c, rs, cs, text, header) of the rows of a table: each cell takes the first column that no cell above reaches into.
    A row without cells counts as a row; spans end with the table."""
    out, reach = [], {}  # column -> row at which it is free again
    for r, row in enumerate(rows):
        c = 0
        for text, down, across, header in row:
            while reach.get(c, 0) > r:
                c += 1
            down, across = min(down, len(rows) - r), min(across, WIDEST)
            out.append((r, c, down, across, text, header))
            reach.update(dict.fromkeys(range(c, c + across), r + down))
            c += across
    return out


def shown(cells: list[tuple[int, int, int, int, str, bool]]) -> str:
    """Rows of a table as text; a cell stands in every place it spans, places without one are empty."""
    grid: dict[int, dict[int, str]] = {}
    for r, c, down, across, text, _ in cells:
        for y in range(r, r + down):
            for x in range(c, c + across):
                grid.setdefault(y, {}).setdefault(x, text.replace("|", "/"))
    wide = max((max(row) for row in grid.values()), default=-1) + 1
    return "\n".join("| " + " | ".join(grid[y].get(x, "") for x in range(wide)) + " |" for y in sorted(grid))


class _Blocks(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[str, int | None, str]] = []
        self.open: tuple[str, int | None] | None = None
        self.text: list[str] = []
        self.rows: list[list[tuple[str, int, int, bool]]] | None = None
        self.cell = (1, 1, False)
        self.tables: dict[int, list[tuple[int, int, int, int, str, bool]]] = {}  # cells by the index of their block
        self.skip = 0

    def _close(self):
        s = " ".join("".join(self.text).split())
        if self.open and s:
            self.out.append((*self.open, s))
        self.open, self.text = None, []

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.skip += 1
        elif tag == "table":
            self._close()
            self.rows = []
        elif self.rows is not None:
            if tag == "tr":
                self.rows.append([])
            elif tag in ("td", "th"):
                named = dict(attrs)
                self.cell = (_span(named.get("rowspan")), _span(named.get("colspan")), tag == "th")
                self.text = []
        elif tag in HEADINGS:
            self._close()
            self.open = ("section_header", HEADINGS[tag])
        elif tag in ("p", "li"):
            self._close()
            self.open = ("list_item" if tag == "li" else "text", None)

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif self.rows is not None:
            if tag in ("td", "th"):
                if not self.rows:
                    self.rows.append([])
                self.rows[-1].append((" ".join("".join(self.text).split()), *self.cell))
                self.text = []
            elif tag == "table":
                cells = placed(self.rows)
                if cells:
                    self.tables[len(self.out)] = cells
                    self.out.append(("table", None, shown(cells)))
                self.rows, self.text = None, []
        elif tag in HEADINGS or tag in ("p", "li"):
            self._close()

    def handle_data(self, data):
        if not self.skip and (self.open or self.rows is not None):
            self.text.append(data)


def _scanned(html: str) -> _Blocks:
    low = html.lower()
    a = low.find("<main")
    b = low.find("</main>", a)
    p = _Blocks()
    p.feed(html[a : b + 7] if 0 <= a < b else html)
    p.close()
    p._close()
    return p


def blocks_of(html: str) -> list[tuple[str, int | None, str]]:
    """(label, heading level, text) of the main part, or of the whole page without one."""
    return _scanned(html).out


def page_blocks(pages: DataFrame) -> DataFrame:
    """(page_id, pos, label, level, text)."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = [(i, pos, *b) for i, h in zip(pdf["page_id"], pdf["html"]) for pos, b in enumerate(blocks_of(h or ""))]
            out = pd.DataFrame(rows, columns=["page_id", "pos", "label", "level", "text"])
            yield out.astype({"level": "Int32"})

    return pages.select(F.col("page_id"), F.col("html")).mapInPandas(run, "page_id long, pos long, label string, level int, text string")


def page_cells(pages: DataFrame) -> DataFrame:
    """(page_id, tbl, pos, r, c, rs, cs, text, header): cells of the tables of each page with their spans; tbl is the position of the table's block.
    Pages without a table give no rows."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = [(i, tbl, pos, *cell) for i, h in zip(pdf["page_id"], pdf["html"]) for tbl, cells in _scanned(h or "").tables.items() for pos, cell in enumerate(cells)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in CELLS.split(", ")])

    return pages.select(F.col("page_id"), F.col("html")).mapInPandas(run, CELLS)
