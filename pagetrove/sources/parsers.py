"""Parsers: a function from the bytes of one file to its pages.

A page is a text, or a pair of text and a dictionary of further metadata. Parsers for PDF rest on
optional packages, which are imported when the first file is parsed inside a task.
"""

import io
from collections.abc import Callable


def plain_text(content: bytes, path: str):
    """The whole file is one page."""
    return [content.decode("utf-8", "replace")]


def form_feed_text(content: bytes, path: str):
    """Pages end with a form feed, as text taken from a PDF usually has it."""
    pages = content.decode("utf-8", "replace").split("\f")
    return pages[:-1] if pages[-1] == "" else pages


def pypdf(content: bytes, path: str):
    from pypdf import PdfReader

    return [page.extract_text() for page in PdfReader(io.BytesIO(content)).pages]


def pymupdf(content: bytes, path: str):
    import fitz

    with fitz.open(stream=content, filetype="pdf") as document:
        return [page.get_text() for page in document]


def pypdfium2(content: bytes, path: str):
    from pypdfium2 import PdfDocument

    return [page.get_textpage().get_text_range() for page in PdfDocument(content)]


def pdfminer(content: bytes, path: str):
    """The whole file is one page."""
    from pdfminer.high_level import extract_text

    return [extract_text(io.BytesIO(content))]


def unstructured(content: bytes, path: str):
    """Element mode: every element of the layout is a page of its own."""
    from unstructured.partition.auto import partition

    return [
        (str(element), {"category": element.category})
        for element in partition(file=io.BytesIO(content), metadata_filename=path)
    ]


_PARSERS = {
    "text": plain_text,
    "form_feed": form_feed_text,
    "PyPDFLoader": pypdf,
    "PyMuPDFLoader": pymupdf,
    "PyPDFium2Loader": pypdfium2,
    "PDFMinerLoader": pdfminer,
    "UnstructuredPDFLoader": unstructured,
    "UnstructuredFileLoader": unstructured,
}


def register_parser(name: str, parse: Callable) -> None:
    """Add a parser by name."""
    _PARSERS[name] = parse


def parser(name_or_function) -> Callable:
    """A parser by name; functions pass through."""
    if callable(name_or_function):
        return name_or_function
    if name_or_function not in _PARSERS:
        raise ValueError(f"unsupported parser: {name_or_function!r}; known: {', '.join(_PARSERS)}")
    return _PARSERS[name_or_function]
