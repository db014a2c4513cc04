"""The text of an RTF file, in plain Python: paragraphs, tabs and characters; what a destination hides stays hidden."""

from __future__ import annotations

import re

#: Groups that hold no text of the document: fixed names of the format.
HIDDEN = frozenset("fonttbl colortbl stylesheet info pict object themedata datastore listtable listoverridetable rsidtbl generator xmlnstbl latentstyles header footer headerl headerr footerl footerr".split())
BREAKS = {
    "par": "\n", "line": "\n", "sect": "\n", "page": "\n", "row": "\n", "tab": "\t", "cell": "\t", "emdash": "—", "endash": "–",
    "bullet": "•", "lquote": "‘", "rquote": "’", "ldblquote": "“", "rdblquote": "”"
}
_TOKEN = re.compile(rb"\\'(?P<hex>[0-9a-fA-F]{2})|\\(?P<word>[a-zA-Z]+)(?P<number>-?\d+)? ?|\\(?P<sign>[^a-zA-Z])|(?P<brace>[{}])|(?P<text>[^\\{}\r\n]+)", re.S)


def rtf(data: bytes) -> str:
    """Paragraphs, an empty line between them."""
    page, groups = "cp1252", []
    hidden, skips, skip = False, 1, 0
    out: list[str] = []
    raw = bytearray()  # bytes of the code page that wait for their text, as a character may have two

    def flush() -> None:
        out.append(raw.decode(page, "replace"))
        raw.clear()

    for m in _TOKEN.finditer(data):
        kind = m.lastgroup if m.lastgroup != "number" else "word"
        if kind == "brace":
            flush()
            if m["brace"] == b"{":
                groups.append((hidden, skips))
            elif groups:
                hidden, skips = groups.pop()
            skip = 0
        elif kind == "sign":
            if m["sign"] == b"*":
                hidden = True
            elif not hidden and m["sign"] in b"\\{}":
                raw += m["sign"]
            elif not hidden and m["sign"] in b"~_-":
                raw += {b"~": b" ", b"_": b"-", b"-": b""}[m["sign"]]
        elif kind == "word":
            word, number = m["word"].decode(), int(m["number"]) if m["number"] else None
            if word in HIDDEN:
                hidden = True
            elif word == "ansicpg" and number:
                page = f"cp{number}"
            elif word == "uc" and number is not None:
                skips = number
            elif word == "u" and number is not None and not hidden:
                flush()
                out.append(chr(number & 0xFFFF))
                skip = skips
            elif word in BREAKS and not hidden:
                flush()
                out.append(BREAKS[word])
        elif not hidden:
            found = bytes.fromhex(m["hex"].decode()) if kind == "hex" else m["text"]
            raw += found[skip:]
            skip = max(0, skip - len(found))
    flush()
    text = "".join(out).encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")
    return "\n\n".join(line.strip() for line in text.split("\n") if line.strip())
