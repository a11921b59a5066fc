"""Tools outside of Python: where they are, and a reader of scanned pages made of them."""

from __future__ import annotations

import os
import shutil
import subprocess
from collections.abc import Callable

from inkmill.operators.ocr import DPI

#: Names of a tool, and where installers put it beside the search path (fixed values).
PLACES = {
    "libreoffice": (["soffice", "libreoffice"], ["/Applications/LibreOffice.app/Contents/MacOS/soffice", r"C:\Program Files\LibreOffice\program\soffice.exe"]),
    "tesseract": (["tesseract"], ["/opt/homebrew/bin/tesseract", r"C:\Program Files\Tesseract-OCR\tesseract.exe"]),
}


def find(tool: str) -> str | None:
    commands, places = PLACES[tool]
    found = (shutil.which(c) for c in commands)
    return next((p for p in [*found, *(p for p in places if os.path.isfile(p))] if p), None)


def need(tool: str) -> str:
    """The path of a tool; RuntimeError with its name where it is not installed."""
    path = find(tool)
    if path is None:
        raise RuntimeError(f"{tool} is not installed: none of {', '.join(PLACES[tool][0])} is on the path")
    return path


def scanned_pages(content: bytes) -> int:
    import fitz

    with fitz.open(stream=content, filetype="pdf") as d:
        return d.page_count


def tesseract_page(languages: str = "chi_sim+chi_tra", dpi: int = DPI, seconds: int = 300) -> Callable[[bytes, int], str]:
    """Recognises one page of a PDF: PyMuPDF draws it, Tesseract reads it.  A failure of either raises."""

    def read(content: bytes, page: int) -> str:
        import fitz

        with fitz.open(stream=content, filetype="pdf") as d:
            image = d[page].get_pixmap(dpi=dpi).tobytes("png")
        done = subprocess.run([need("tesseract"), "stdin", "stdout", "-l", languages], input=image, capture_output=True, timeout=seconds, check=False)
        if done.returncode:
            raise RuntimeError(f"tesseract ended with {done.returncode}: {done.stderr.decode('utf-8', 'replace')[:500]}")
        return done.stdout.decode("utf-8", "ignore").strip()

    return read
