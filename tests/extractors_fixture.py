"""Stand-in extractors for CLI tests (imported by path, pickled by value)."""


def make_ocr():
    def fn(png, box):
        w = int.from_bytes(png[16:20], "big")
        return [[{"text": f"w{w}", "confidence": 0.9}]]
    return fn


def make_pdf():
    def fn(b):
        if not b.startswith(b"%PDF"):
            raise ValueError("not a pdf")
        return b[4:].decode().split("\f")
    return fn
