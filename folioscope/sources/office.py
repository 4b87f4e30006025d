"""Word and spreadsheet files to Markdown, by their XML parts."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from datetime import datetime, timedelta
from xml.etree import ElementTree

from folioscope.sources.markup import table_markdown

# Names of the formats' namespaces and of built-in date formats.
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
DATE_FORMATS = {*range(14, 18), 22, *range(27, 32), 36, *range(45, 48), *range(50, 59)}
MONO = re.compile(r"courier|consolas|mono|menlo", re.I)


def _part(archive: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    try:
        return ElementTree.fromstring(archive.read(name))
    except (KeyError, ElementTree.ParseError):
        return None


def _targets(root: ElementTree.Element | None) -> dict[str, tuple[str, str]]:
    return {} if root is None else {e.get("Id", ""): (e.get("Type", "").rsplit("/", 1)[-1], e.get("Target", "")) for e in root}


def core_properties(archive: zipfile.ZipFile) -> dict[str, str]:
    root = _part(archive, "docProps/core.xml")
    return {} if root is None else {e.tag.rsplit("}", 1)[-1]: e.text.strip() for e in root if e.text and e.text.strip()}


class _Word:
    def __init__(self, archive: zipfile.ZipFile) -> None:
        self.targets = _targets(_part(archive, "word/_rels/document.xml.rels"))
        self.counts = {"horizontal_rules": 0, "unresolved_images": 0}
        self.ordered = self._numbering(_part(archive, "word/numbering.xml"))

    @staticmethod
    def _numbering(root: ElementTree.Element | None) -> set[tuple[str, str]]:
        """(list, level) that count instead of showing bullets."""
        if root is None:
            return set()
        kinds = {a.get(W + "abstractNumId"): {lvl.get(W + "ilvl") for lvl in a.iter(W + "lvl") if (f := lvl.find(W + "numFmt")) is not None and f.get(W + "val") != "bullet"} for a in root.iter(W + "abstractNum")}
        out = set()
        for num in root.iter(W + "num"):
            ref = num.find(W + "abstractNumId")
            out |= {(num.get(W + "numId"), level) for level in kinds.get(ref.get(W + "val") if ref is not None else None, ())}
        return out

    def run(self, el: ElementTree.Element) -> str:
        props = el.find(W + "rPr")
        has = lambda name: props is not None and (p := props.find(W + name)) is not None and p.get(W + "val") not in ("0", "false")
        text, after = "", ""
        for child in el:
            kind = child.tag.removeprefix(W)
            if kind in ("t", "delText"):
                text += child.text or ""
            elif kind == "tab":
                text += "\t"
            elif kind in ("br", "cr"):
                text += "  \n"
            elif kind in ("footnoteReference", "endnoteReference", "commentReference"):
                after += f"[^{ {'f': 'fn', 'e': 'en', 'c': 'c'}[kind[0]] }{child.get(W + 'id')}]"
            elif kind in ("drawing", "pict"):
                after += self.picture(child)
            elif kind == "object":
                after += "[embedded object]"
        fonts = props.find(W + "rFonts") if props is not None else None
        mark = "`" if fonts is not None and MONO.search(" ".join(fonts.attrib.values())) else "**" * has("b") + "*" * has("i")
        return (f"{mark}{text}{mark}" if text.strip() and mark else text) + after

    def picture(self, el: ElementTree.Element) -> str:
        if any(e.tag.endswith("}rect") for e in el.iter()) and not any("imagedata" in e.tag for e in el.iter()):
            self.counts["horizontal_rules"] += 1
            return "\n---\n"
        for e in el.iter():
            target = self.targets.get(e.get(R + "embed") or e.get(R + "id") or "")
            if target:
                return f"![]({target[1].rsplit('/', 1)[-1]})"
        self.counts["unresolved_images"] += 1
        return "[image]"

    def content(self, el: ElementTree.Element) -> str:
        out = ""
        for child in el:
            kind = child.tag.removeprefix(W)
            if kind == "r":
                out += self.run(child)
            elif kind == "hyperlink":
                inner, target = self.content(child), self.targets.get(child.get(R + "id") or "")
                out += f"[{inner}]({target[1]})" if target and inner else inner
            elif kind in ("ins", "smartTag", "sdt", "sdtContent", "fldSimple"):
                out += self.content(child)
            elif kind == "del":
                gone = "".join(t.text or "" for t in child.iter(W + "delText"))
                out += f"~~{gone}~~" if gone else ""
        return out

    def paragraph(self, el: ElementTree.Element) -> str:
        props = el.find(W + "pPr")
        value = lambda path: (e.get(W + "val") or "") if props is not None and (e := props.find(path)) is not None else ""
        style, text = value(W + "pStyle").lower(), self.content(el).rstrip()
        number, level = value(f"{W}numPr/{W}numId"), value(f"{W}numPr/{W}ilvl") or "0"
        if not text:
            return ""
        heading = re.fullmatch(r"heading ?([1-6])", style)
        if heading or style == "title":
            return "#" * (int(heading.group(1)) if heading else 1) + " " + text
        if "code" in style or "preformatted" in style:
            return f"```\n{text}\n```"
        if number and number != "0":
            return "  " * int(level if level.isdigit() else 0) + ("1. " if (number, level) in self.ordered else "- ") + text
        return f"> {text}" if "quote" in style else text

    def block(self, el: ElementTree.Element) -> list[str]:
        if el.tag == W + "p":
            made = self.paragraph(el)
            return [made] if made else []
        if el.tag == W + "tbl":
            rows = [[" ".join(filter(None, (self.paragraph(p) for p in cell.iter(W + "p")))).replace("|", "\\|").replace("\n", " ") for cell in row.findall(W + "tc")] for row in el.findall(W + "tr")]
            made = table_markdown([r for r in rows if r])
            return [made] if made else []
        return [b for child in el for b in self.block(child)] if el.tag in (W + "sdt", W + "sdtContent", W + "ins") else []

    def notes(self, root: ElementTree.Element | None, tag: str, short: str, title: str) -> list[str]:
        if root is None:
            return []
        found = []
        for note in root.findall(W + tag):
            if note.get(W + "type") in ("separator", "continuationSeparator", "continuationNotice"):
                continue
            text = " ".join(filter(None, (self.paragraph(p) for p in note.iter(W + "p"))))
            who = f"**{note.get(W + 'author')}:** " if note.get(W + "author") else ""
            found.append((note.get(W + "id") or "", f"[^{short}{note.get(W + 'id')}]: {who}{text}"))
        # numbers first, in their order
        found.sort(key=lambda n: (not n[0].lstrip("-").isdigit(), int(n[0]) if n[0].lstrip("-").isdigit() else 0, n[0]))
        return [f"## {title}", "\n".join(text for _, text in found)] if found else []


def docx_to_markdown(data: bytes) -> tuple[dict[str, str], str]:
    """(metadata, Markdown). Content controls and nested runs are read as well. Raises ValueError where it is no document."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile as e:
        raise ValueError("not a zip archive") from e
    root = _part(archive, "word/document.xml")
    body = root.find(W + "body") if root is not None else None
    if body is None:
        raise ValueError("no document body")
    word = _Word(archive)
    blocks = [b for child in body for b in word.block(child)]
    for name, tag, short, title in (("footnotes", "footnote", "fn", "Footnotes"), ("endnotes", "endnote", "en", "Endnotes"), ("comments", "comment", "c", "Comments")):
        blocks += word.notes(_part(archive, f"word/{name}.xml"), tag, short, title)
    meta = {"source": "docx", **core_properties(archive), **{k: str(v) for k, v in word.counts.items() if v}}
    text = "\n\n".join(blocks)
    if meta.get("title") and not text.startswith("# "):
        text = f"# {meta['title']}\n\n{text}"
    return meta, text + "\n"


def column_number(letters: str) -> int:
    total = 0
    for c in letters:
        total = total * 26 + ord(c) - 64
    return total


def column_letters(number: int) -> str:
    out = ""
    while number > 0:
        number, rest = divmod(number - 1, 26)
        out = chr(65 + rest) + out
    return out


def cell_place(ref: str) -> tuple[int, int]:
    m = re.match(r"\$?([A-Z]{1,4})\$?(\d+)", ref)
    return (int(m.group(2)), column_number(m.group(1))) if m else (0, 0)


def serial_date(serial: float) -> str:
    """A day number as text; empty below 1 and beyond the calendar."""
    if not 1 <= serial < 2_958_466:
        return ""
    at = datetime(1899, 12, 30) + timedelta(days=int(serial), seconds=round((serial - int(serial)) * 86_400))
    return at.strftime("%Y-%m-%d" if serial == int(serial) else "%Y-%m-%d %H:%M:%S")


def _date_styles(root: ElementTree.Element | None) -> set[int]:
    if root is None:
        return set()
    own = {int(f.get("numFmtId", 0)) for f in root.iter(S + "numFmt") if re.search(r"yy|mm|dd|hh|ss", re.sub(r'"[^"]*"', "", f.get("formatCode", "")).lower())}
    styles = root.find(S + "cellXfs")
    return {i for i, x in enumerate(styles) if int(x.get("numFmtId", 0)) in own | DATE_FORMATS} if styles is not None else set()


def _beside(archive: zipfile.ZipFile, part: str, root: ElementTree.Element) -> dict[str, list]:
    """What a sheet holds besides its cells: links (row, column, address), comments (place, author, text) and merged ranges."""
    folder, _, name = part.rpartition("/")
    targets = _targets(_part(archive, f"{folder}/_rels/{name}.rels"))
    links = []
    for h in root.iter(S + "hyperlink"):
        address = targets.get(h.get(R + "id", ""), ("", ""))[1] or (f"#{h.get('location')}" if h.get("location") else "")
        first, _, last = h.get("ref", "").partition(":")
        (r1, c1), (r2, c2) = cell_place(first), cell_place(last or first)
        links += [(r, c, address) for r in range(r1, r2 + 1) for c in range(c1, c2 + 1) if address]
    comments = []
    for kind, target in targets.values():
        notes = _part(archive, posixpath.normpath(f"{folder}/{target}")) if kind == "comments" else None
        if notes is not None:
            authors = [a.text or "" for a in notes.iter(S + "author")]
            for c in notes.iter(S + "comment"):
                number = int(c.get("authorId", -1))
                comments.append((c.get("ref", ""), authors[number] if 0 <= number < len(authors) else "unknown", "".join(t.text or "" for t in c.iter(S + "t")).strip().replace("\n", " ")))
    return {"links": links, "comments": sorted(comments, key=lambda c: cell_place(c[0])), "merges": [m.get("ref", "") for m in root.iter(S + "mergeCell")]}


Cells = list[tuple[str, bool, int, int, str, str]]


def workbook_cells(data: bytes) -> tuple[dict[str, str], Cells]:
    """(metadata, cells): (sheet, hidden, row, column, value, formula) in the order of the workbook, merged ranges filled."""
    meta, cells, _ = workbook(data)
    return meta, cells


def workbook(data: bytes) -> tuple[dict[str, str], Cells, dict[str, dict[str, list]]]:
    """(metadata, cells, what each sheet holds besides)."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile as e:
        raise ValueError("not a zip archive") from e
    book = _part(archive, "xl/workbook.xml")
    if book is None:
        raise ValueError("no workbook")
    shared = _part(archive, "xl/sharedStrings.xml")
    strings = ["".join(t.text or "" for t in si.iter(S + "t")) for si in shared.findall(S + "si")] if shared is not None else []
    dates, targets = _date_styles(_part(archive, "xl/styles.xml")), _targets(_part(archive, "xl/_rels/workbook.xml.rels"))
    cells: Cells = []
    beside: dict[str, dict[str, list]] = {}
    names = []
    for sheet in book.iter(S + "sheet"):
        name, hidden = sheet.get("name", ""), sheet.get("state", "visible") != "visible"
        names.append(name)
        target = targets.get(sheet.get(R + "id", ""), ("", ""))[1].lstrip("/")
        part = target if target.startswith("xl/") else f"xl/{target}"
        root = _part(archive, part)
        if root is None:
            continue
        beside[name] = _beside(archive, part, root)
        found: dict[tuple[int, int], tuple[str, str]] = {}
        for c in root.iter(S + "c"):
            kind, raw = c.get("t", "n"), c.findtext(S + "v") or ""
            formula = c.findtext(S + "f") or ""
            if kind == "s":
                value = strings[int(raw)] if raw.isdigit() and int(raw) < len(strings) else ""
            elif kind == "inlineStr":
                value = "".join(t.text or "" for t in c.iter(S + "t"))
            elif kind == "b":
                value = "TRUE" if raw == "1" else "FALSE"
            elif kind == "n" and raw and int(c.get("s", 0)) in dates:
                value = serial_date(float(raw))
            else:
                value = raw
            if value or formula:
                found[cell_place(c.get("r", ""))] = value, formula
        rows_used, columns_used = max((r for r, _ in found), default=0), max((c for _, c in found), default=0)
        for merge in root.iter(S + "mergeCell"):
            first, _, last = merge.get("ref", "").partition(":")
            (r1, c1), (r2, c2) = cell_place(first), cell_place(last or first)
            if (r1, c1) in found:
                # a merged range reaches no further than the rows and columns in use, so that whole merged columns stay bounded
                for r in range(r1, min(r2, rows_used) + 1):
                    for k in range(c1, min(c2, columns_used) + 1):
                        found.setdefault((r, k), (found[r1, c1][0], ""))
        cells += [(name, hidden, r, k, v, f) for (r, k), (v, f) in sorted(found.items())]
    return {"source": "xlsx", "sheet_count": str(len(names)), "sheet_names": ", ".join(names), **core_properties(archive)}, cells, beside


def xlsx_to_markdown(data: bytes) -> tuple[dict[str, str], str]:
    """(metadata, Markdown): a grid with column letters and row numbers for each sheet, and its formulas."""
    meta, cells, beside = workbook(data)
    by_sheet: dict[tuple[str, bool], dict[tuple[int, int], tuple[str, str]]] = {}
    for name, hidden, r, c, value, formula in cells:
        by_sheet.setdefault((name, hidden), {})[r, c] = value, formula
    out = []
    for (name, hidden), found in by_sheet.items():
        rows, columns = sorted({r for r, _ in found}), sorted({c for _, c in found})
        span = range(columns[0], columns[-1] + 1)
        extra = beside.get(name, {})
        links = {(r, c): address for r, c, address in extra.get("links", ())}
        escape = lambda v: v.replace("\\", "\\\\").replace("|", "\\|").replace("\n", "<br>")
        grid = [["#", *map(column_letters, span)]]
        for before, r in zip([rows[0], *rows], rows):
            # a gap of empty rows is one marked row, however long
            if r - before > 1:
                grid.append([f"{before + 1}-{r - 1}" if r - before > 2 else str(r - 1), *[""] * len(span)])
            shown = [escape(found.get((r, c), ("", ""))[0]) for c in span]
            grid.append([str(r), *[f"[{v}]({links[r, c]})" if v and (r, c) in links else v for c, v in zip(span, shown)]])
        out.append(f"## Sheet: {name}{' (hidden)' if hidden else ''}\n\n{table_markdown(grid)}")
        if extra.get("merges"):
            out.append("### Merged ranges\n\n" + "\n".join(f"- {m}" for m in extra["merges"]))
        formulas = [f"- `{column_letters(c)}{r}`: `={f}`" for (r, c), (_, f) in sorted(found.items()) if f]
        if formulas:
            out.append("### Formulas\n\n" + "\n".join(formulas))
        if extra.get("comments"):
            out.append("### Comments\n\n" + "\n".join(f"- **{place}** — {author}: {said}" for place, author, said in extra["comments"]))
    return meta, "\n\n".join(out) + "\n"
