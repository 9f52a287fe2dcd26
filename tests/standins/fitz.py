"""A stand-in for a PDF library: a file is %PDF and a JSON list with the text of each page."""

import json

csRGB, csGRAY = 3, 1  # noqa: N816


class Matrix:
    def __init__(self, x, y):
        self.x, self.y = x, y


class Pixmap:
    def __init__(self, width, height, samples):
        self.width, self.height, self.samples = width, height, samples


class Page:
    def __init__(self, text):
        self.text = text

    def get_pixmap(self, matrix, colorspace, alpha):
        if self.text == "broken":
            raise ValueError("broken page")
        return Pixmap(int(10 * matrix.x), int(20 * matrix.y), self.text.encode() * colorspace)


class Document:
    def __init__(self, pages):
        self.pages = pages

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False

    def __len__(self):
        return len(self.pages)

    def __iter__(self):
        return map(Page, self.pages)

    def insert_pdf(self, other, from_page, to_page):
        self.pages += other.pages[from_page : to_page + 1]

    def tobytes(self):
        return b"%PDF" + json.dumps(self.pages).encode()


def open(stream=None, filetype=None):  # noqa: A001
    if stream is None:
        return Document([])
    if stream[:4] != b"%PDF" or filetype != "pdf":
        raise ValueError("no PDF")
    return Document(json.loads(stream[4:]))
