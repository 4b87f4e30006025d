"""HTML and RTF to Markdown, in plain Python; ``convert.py`` runs it over tables.

Unlike a straight pass over tags, HTML becomes a tree first, so marks inside table cells stay in their cell and
links keep their text.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = {"br", "hr", "img", "meta", "link", "input", "area", "base", "col", "embed", "source", "track", "wbr"}
HIDDEN = {"head", "script", "style", "template", "noscript"}
MARKS = {"strong": "**", "b": "**", "u": "**", "em": "*", "i": "*", "s": "~~", "strike": "~~", "del": "~~"}
BLOCKS = set("p div section article header footer nav main aside address figure figcaption form fieldset body html dl dt dd li ul ol blockquote pre table hr h1 h2 h3 h4 h5 h6".split())
META = {"creator": "author", "keywords": "keywords_meta", "author": "author", "description": "description", "created": "created", "modified": "modified", "date": "date", "subject": "subject"}


class Node:
    def __init__(self, tag: str, attrs: dict[str, str | None]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []


class _Tree(HTMLParser):
    """A tree of nodes and strings. An end tag closes the nearest open one of its name; others are ignored."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("root", {})
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "li" or tag in ("td", "th", "tr"):
            self._close_sibling(tag)
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def _close_sibling(self, tag: str) -> None:
        kin = {"li": ({"li"}, {"ul", "ol"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"})}[tag]
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in kin[1]:
                return
            if self.open[i].tag in kin[0]:
                del self.open[i:]
                return

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def _text(node: Node) -> str:
    out, stack = [], [node]
    while stack:
        now = stack.pop()
        if isinstance(now, str):
            out.append(now)
        else:
            stack.extend(reversed(now.children))
    return "".join(out)


def _inline(node: Node, depth: int = 0) -> str:
    out = []
    for child in node.children:
        if isinstance(child, str):
            out.append(re.sub(r"[\t\n\r ]+", " ", child))
        elif child.tag in HIDDEN or depth > 200:
            continue
        elif child.tag == "br":
            out.append("  \n")
        elif child.tag == "img":
            out.append(f"![{child.attrs.get('alt') or ''}]({child.attrs.get('src') or ''})")
        elif child.tag == "code":
            out.append(f"`{_text(child).strip()}`")
        elif child.tag == "a" and child.attrs.get("href"):
            out.append(f"[{_inline(child, depth + 1).strip()}]({child.attrs['href']})")
        else:
            inner = _inline(child, depth + 1)
            mark = MARKS.get(child.tag, "") if inner.strip() else ""
            out.append(f"{mark}{inner}{mark}")
    return "".join(out)


def table_markdown(rows: list[list[str]]) -> str:
    """The first row as heading; short rows are filled."""
    width = max((len(r) for r in rows), default=0)
    if not width:
        return ""
    full = [[*r, *[" "] * (width - len(r))] for r in rows]
    lines = ["| " + " | ".join(c or " " for c in r) + " |" for r in full]
    return "\n".join([lines[0], "|" + " --- |" * width, *lines[1:]])


def _rows(node: Node) -> list[list[str]]:
    rows = []
    for child in node.children:
        if isinstance(child, str):
            continue
        if child.tag == "tr":
            rows.append([_inline(c).strip().replace("|", "\\|").replace("\n", " ") for c in child.children if not isinstance(c, str) and c.tag in ("td", "th")])
        elif child.tag in ("thead", "tbody", "tfoot"):
            rows += _rows(child)
    return [r for r in rows if r]


def _list(node: Node, depth: int) -> list[str]:
    out, number = [], int(node.attrs.get("start") or 1) if str(node.attrs.get("start") or "1").isdigit() else 1
    for item in node.children:
        if isinstance(item, str) or item.tag != "li":
            continue
        own = Node("li", {})
        below: list[str] = []
        for child in item.children:
            if not isinstance(child, str) and child.tag in ("ul", "ol"):
                below += _list(child, depth + 1)
            else:
                own.children.append(child)
        out.append("  " * depth + (f"{number}. " if node.tag == "ol" else "- ") + re.sub(r"\s+", " ", _inline(own)).strip())
        out += below
        number += 1
    return out


def _blocks(node: Node, depth: int = 0) -> list[str]:
    out: list[str] = []
    run = Node("run", {})

    def flush() -> None:
        text = _inline(run).strip()
        if text:
            out.append(text)
        run.children.clear()

    for child in node.children:
        if isinstance(child, str) or child.tag not in BLOCKS:
            if not isinstance(child, str) and any(not isinstance(c, str) and c.tag in BLOCKS for c in child.children) and child.tag not in HIDDEN and depth < 200:
                flush()
                out += _blocks(child, depth + 1)
            else:
                run.children.append(child)
            continue
        flush()
        if re.fullmatch(r"h[1-6]", child.tag):
            title = re.sub(r"\s+", " ", _inline(child)).strip()
            out += ["#" * int(child.tag[1]) + " " + title] if title else []
        elif child.tag == "hr":
            out.append("---")
        elif child.tag == "pre":
            out.append("```\n" + _text(child).strip("\n") + "\n```")
        elif child.tag in ("ul", "ol"):
            out.append("\n".join(_list(child, 0)))
        elif child.tag == "table":
            out.append(table_markdown(_rows(child)))
        elif child.tag == "blockquote":
            out.append("\n".join("> " + line for line in "\n\n".join(_blocks(child, depth + 1)).split("\n")))
        elif child.tag == "dt":
            out.append(f"**{_inline(child).strip()}**")
        elif depth < 200:
            out += _blocks(child, depth + 1)
    flush()
    return [b for b in out if b]


def html_to_markdown(text: str | None) -> tuple[dict[str, str], str]:
    """(metadata, Markdown). A page without a top heading gets its title as one."""
    tree = _Tree()
    tree.feed(text or "")
    tree.close()
    meta: dict[str, str] = {}
    stack = [tree.root]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            continue
        if node.tag == "title" and _text(node).strip():
            meta.setdefault("title", _text(node).strip())
        name = (node.attrs.get("name") or "").lower()
        if node.tag == "meta" and name and node.attrs.get("content"):
            meta.setdefault(META.get(name, f"meta_{name}"), node.attrs["content"])
        stack.extend(reversed(node.children))
    body = "\n\n".join(_blocks(tree.root))
    if meta.get("title") and not re.search(r"(?m)^# ", body):
        body = f"# {meta['title']}\n\n{body}"
    return meta, re.sub(r"\n{3,}", "\n\n", body).strip() + "\n"


_RTF = re.compile(r"\\([a-z]{1,32})(-?\d{1,10})?[ ]?|\\'([0-9a-fA-F]{2})|\\([^a-z])|([{}])|[\r\n]+|([^\\{}\r\n]+)", re.I)
_RTF_SKIP = {"fonttbl", "colortbl", "stylesheet", "info", "pict", "object", "header", "footer", "generator", "themedata", "listtable", "listoverridetable", "rsidtbl", "xmlnstbl", "datastore", "latentstyles", "pntxta", "pntxtb", "pntext", "listtext"}
_RTF_SIGNS = {"emdash": "—", "endash": "–", "bullet": "•", "lquote": "‘", "rquote": "’", "ldblquote": "“", "rdblquote": "”", "tab": "\t", "line": "  \n", "~": " "}


#: Marks that open and close a run: bold and italics together are one mark, underlining and striking go around it.
_RTF_MARKS = {(False, False): "", (True, False): "**", (False, True): "*", (True, True): "***"}


def _rtf_run(pieces: list[tuple[str, bool, bool, str]]) -> str:
    """Pieces (mark, underlined, struck, text) of one paragraph or link."""
    text, mark = "", ""
    for now, under, struck, piece in pieces:
        if under and piece.strip():
            piece = f"<u>{piece}</u>"
        if struck and piece.strip():
            piece = f"~~{piece}~~"
        if now != mark:
            text, mark = _closed(text, mark) + now, now
        text += piece
    return _closed(text, mark)


def rtf_to_markdown(data: bytes | None) -> tuple[dict[str, int], str]:
    """(metadata, Markdown) with marks of type, links, bullets and numbers of lists, and headings by size of type."""
    source = (data or b"").decode("latin-1")
    state = {"b": False, "i": False, "ul": False, "strike": False, "fs": 24, "skip": False, "uc": 1, "cp": "cp1252", "field": "", "href": ""}
    stack, paragraphs, run, skip_chars = [], [], [], 0
    address: list[str] = []
    bullet = ""

    def flush() -> None:
        sizes = [fs for *_, fs, t in run if t.strip()]
        parts: list[tuple[str, list]] = []
        for href, mark, under, struck, _, piece in run:
            if not parts or parts[-1][0] != href:
                parts.append((href, []))
            parts[-1][1].append((mark, under, struck, piece))
        text = "".join(f"[{_rtf_run(own).strip()}]({href})" if href else _rtf_run(own) for href, own in parts).strip()
        if text:
            size = max(sizes, default=24)
            level = 1 if size >= 48 else 2 if size >= 36 else 3 if size >= 28 else 0
            paragraphs.append("#" * level + " " + text.replace("*", "").strip() if level else bullet + text)
        run.clear()

    def add(piece: str) -> None:
        if state["field"] == "inst":
            address.append(piece)
        elif not state["skip"]:
            run.append((state["href"], _RTF_MARKS[state["b"], state["i"]], state["ul"], state["strike"], state["fs"], piece))

    for m in _RTF.finditer(source):
        word, number, code, sign, brace, plain = m.groups()
        if brace == "{":
            stack.append(dict(state))
        elif brace == "}":
            state = stack.pop() if stack else state
        elif code is not None:
            if skip_chars:
                skip_chars -= 1
            else:
                try:
                    add(bytes([int(code, 16)]).decode(state["cp"]))
                except (LookupError, UnicodeDecodeError):
                    add(bytes([int(code, 16)]).decode("latin-1"))
        elif sign is not None:
            if sign == "*":
                state["skip"] = True
            elif sign in "\\{}":
                add(sign)
            elif sign == "~":
                add(" ")
        elif word is not None:
            value = int(number) if number else None
            if word in _RTF_SKIP:
                state["skip"] = True
            elif word in ("par", "sect", "page", "row"):
                flush()
            elif word in ("b", "i", "ul", "strike"):
                state[word] = value != 0
            elif word == "ulnone":
                state["ul"] = False
            elif word == "plain":
                state.update(b=False, i=False, ul=False, strike=False, fs=24)
            elif word == "pard":
                bullet = ""
            elif word in ("pnlvlblt", "pnlvlbody", "pndec"):
                bullet = "- " if word == "pnlvlblt" else "1. "
            elif word == "fldinst":
                address.clear()
                state.update(skip=False, field="inst")
            elif word == "fldrslt":
                target = re.search(r'HYPERLINK\s+"?([^"\s]+)', "".join(address))
                state.update(skip=False, field="", href=target.group(1) if target else "")
            elif word == "fs" and value:
                state["fs"] = value
            elif word == "ansicpg" and value:
                state["cp"] = f"cp{value}"
            elif word == "uc" and value is not None:
                state["uc"] = value
            elif word == "u" and value is not None:
                add(chr(value % 65536))
                skip_chars = state["uc"]
            elif word in _RTF_SIGNS:
                add(_RTF_SIGNS[word])
        elif plain is not None:
            if skip_chars:
                cut = min(skip_chars, len(plain))
                plain, skip_chars = plain[cut:], skip_chars - cut
            add(plain)
    flush()
    body = "\n\n".join(paragraphs)
    body = body.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return {"word_count": len(re.findall(r"\b\w+\b", body))}, body + "\n" if body else ""


def _closed(text: str, mark: str) -> str:
    """Text with its mark closed, white space left outside of it."""
    if not mark:
        return text
    bare = text.rstrip()
    if bare.endswith(mark):
        return bare[: -len(mark)] + text[len(bare) :]
    return bare + mark + text[len(bare) :]
