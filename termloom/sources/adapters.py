"""Readers of PDF files, for tools that may be installed on executors: text, words with their places, and recognised words.

Each is a factory of a ``mapInPandas`` step over files (doc_id, content) and gives plain
rows; grouping into lines is the engine's. A tool that is missing is an error row, so the
other documents go on.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGES = "doc_id string, page int, text string, error string"
WORDS = "doc_id string, page int, width double, height double, text string, x0 double, y0 double, x1 double, y1 double, confidence double, cell string, error string"


def pdf_text(content: bytes) -> list[str]:
    """The text of each page, by pypdf."""
    from pypdf import PdfReader  # type: ignore[import-not-found]

    return [page.extract_text() or "" for page in PdfReader(io.BytesIO(content)).pages]


def plumbed_words(content: bytes) -> list[tuple]:
    """Each page's words and table cells, by pdfplumber; a cell is named by its table, row and column."""
    import pdfplumber  # type: ignore[import-not-found]

    out: list[tuple] = []
    with pdfplumber.open(io.BytesIO(content)) as pdf:
        for n, page in enumerate(pdf.pages, 1):
            size = float(page.width), float(page.height)
            for w in page.extract_words(use_text_flow=True, keep_blank_chars=False) or []:
                out.append((n, *size, str(w["text"]), float(w["x0"]), float(w["top"]), float(w["x1"]), float(w["bottom"]), 1.0, None))
            for t, table in enumerate(page.find_tables(), 1):
                for r, row in enumerate(table.rows, 1):
                    for c, box in enumerate(row.cells, 1):
                        if box is not None:
                            out.append((n, *size, (page.crop(box).extract_text() or "").strip(), *map(float, box), 1.0, f"page={n};table={t};row={r};col={c}"))
    return out


def recognised_words(content: bytes, scale: float = 2.0, language: str = "eng") -> list[tuple]:
    """Each page's words as Tesseract reads them from its image, in the page's own measure; blanks and words without a confidence are left."""
    import pypdfium2  # type: ignore[import-not-found]
    import pytesseract  # type: ignore[import-not-found]

    out: list[tuple] = []
    document = pypdfium2.PdfDocument(content)
    try:
        for n in range(len(document)):
            image = document[n].render(scale=scale).to_pil()
            data = pytesseract.image_to_data(image, lang=language, output_type=pytesseract.Output.DICT)
            for text, conf, x, y, w, h in zip(data["text"], data["conf"], data["left"], data["top"], data["width"], data["height"], strict=True):
                if str(text).strip() and float(conf) >= 0:
                    out.append((n + 1, image.width / scale, image.height / scale, str(text).strip(), x / scale, y / scale, (x + w) / scale, (y + h) / scale, min(max(float(conf) / 100, 0.0), 1.0), None))
    finally:
        document.close()
    return out


def _mapped(files: DataFrame, schema: str, read: Callable[[bytes], list[tuple]]) -> DataFrame:
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc, content in zip(batch["doc_id"], batch["content"], strict=True):
                try:
                    got = [(doc, *r, None) for r in read(bytes(content))]
                except ImportError as e:
                    got = [(doc, *[None] * (len(names) - 2), f"missing tool: {e.name}")]
                except Exception as e:  # noqa: BLE001  (whatever a file does to a tool is that file's error)
                    got = [(doc, *[None] * (len(names) - 2), f"unreadable: {type(e).__name__}")]
                told = pd.DataFrame(got, columns=names)
                told["page"] = told["page"].astype("Int32")
                yield told

    return files.select("doc_id", "content").mapInPandas(rows, schema)


def pdf_pages(files: DataFrame, read: Callable[[bytes], list[str]] = pdf_text) -> DataFrame:
    """doc_id, page, text, error of PDF files."""
    return _mapped(files, PAGES, lambda c: list(enumerate(read(c), 1)))


def pdf_words(files: DataFrame, read: Callable[[bytes], list[tuple]] = plumbed_words) -> DataFrame:
    """Words (and cells) of PDF files with their boxes, as ``plumbed_words`` or ``recognised_words`` reads them."""
    return _mapped(files, WORDS, read)


def word_lines(words: DataFrame) -> DataFrame:
    """Lines of printed words: those of equal height (to a tenth) in a page, from left to right, with the box that holds all."""
    plain = words.where("error IS NULL AND cell IS NULL").withColumn("top", F.round("y0", 1))
    seq = F.array_sort(F.collect_list(F.struct("x0", "text")))
    per = plain.groupBy("doc_id", "page", "top").agg(F.array_join(F.transform(seq, lambda w: w["text"]), " ").alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.avg("confidence").alias("confidence"), F.count(F.lit(1)).alias("n_words"))
    from pyspark.sql import Window as W

    return per.withColumn("line", F.row_number().over(W.partitionBy("doc_id", "page").orderBy("top"))).withColumn("locator", F.concat(F.lit("page="), F.col("page").cast("string"), F.lit(";line="), F.col("line").cast("string"))).drop("top")


def cells(words: DataFrame) -> DataFrame:
    """Table cells of PDF pages, with their locator."""
    return words.where("error IS NULL AND cell IS NOT NULL").select("doc_id", "page", F.col("cell").alias("locator"), "text", "x0", "y0", "x1", "y1")


def layout_adapter(name: str) -> Callable[[bytes], list[tuple]] | None:
    """The reader of a layout tool; None for plain text."""
    known = {"text": None, "pdfplumber": plumbed_words, "ocr": recognised_words}
    if name not in known:
        raise ValueError(f"unsupported layout adapter: {name}")
    return known[name]
