"""Marked-up texts as plain text or Markdown: answers and comments in HTML, wikitext, books, memos, transcripts.

HTML goes through a parser, wikitext through a scanner that keeps its nesting, books and memos line by line. All run over
Arrow batches.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def mapped(use: Callable[[str], str]) -> Callable[[Column], Column]:
    """A column function of a function of texts; nulls stay null."""

    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else use(x))

    return run


def _settled(text: str) -> str:
    """Lines without blanks at their ends, at most one empty line between two."""
    return re.sub(r"\n{3,}", "\n\n", "\n".join(line.rstrip(" \t") for line in text.split("\n"))).strip()


# --- HTML ------------------------------------------------------------------------------------------------------------


class _Renderer(HTMLParser):
    """Collects text; an open element that is rendered as a whole gathers its own and is closed by ``close_<tag>`` of ``whole``."""

    def __init__(self, before: dict[str, str], after: dict[str, str], whole: dict[str, Callable[[str, dict], str]]) -> None:
        super().__init__(convert_charrefs=True)
        self.before, self.after, self.whole = before, after, whole
        self.stack: list[tuple[str, dict, list[str]]] = [("", {}, [])]

    def put(self, text: str) -> None:
        self.stack[-1][2].append(text)

    def handle_starttag(self, tag, attrs):
        inside = {t for t, _, _ in self.stack}
        if tag in self.whole and not (tag == "code" and "pre" in inside):
            self.stack.append((tag, dict(attrs), []))
        else:
            self.put(self.before.get(tag, ""))

    def handle_startendtag(self, tag, attrs):
        self.put(self.before.get(tag, ""))

    def handle_endtag(self, tag):
        if tag in {t for t, _, _ in self.stack}:
            while True:
                own, attrs, parts = self.stack.pop()
                self.put(self.whole[own]("".join(parts), attrs))
                if own == tag:
                    break
        else:
            self.put(self.after.get(tag, ""))

    def handle_data(self, data):
        self.put(data)

    def text(self) -> str:
        self.close()
        while len(self.stack) > 1:
            own, attrs, parts = self.stack.pop()
            self.put(self.whole[own]("".join(parts), attrs))
        return "".join(self.stack[0][2])


_HEADINGS = {f"h{k}": lambda x, _: f"\n## {x.strip()}\n" for k in range(1, 7)}
_BODY = {
    "pre": lambda x, _: "\n\n" + "\n".join(f"    {line}" for line in x.strip().split("\n")) + "\n\n",
    "code": lambda x, _: f"`{x.strip()}`",
    "li": lambda x, _: f"\n- {x.strip()}",
    **_HEADINGS,
}
_COMMENT = {
    "pre": lambda x, _: f"\n```\n{x}\n```\n",
    "i": lambda x, _: f"*{x}*",
    "a": lambda x, attrs: f"[{x}]({attrs['href']})" if attrs.get("href") else x,
}


def body_text(source: str) -> str:
    """Code blocks indented, inline code in backticks, list items and headings marked, breaks and paragraphs as line ends."""
    r = _Renderer({"br": "\n", "p": "\n"}, {"p": "\n"}, _BODY)
    r.feed(source)
    return _settled(re.sub(r"(?<=\S) {2,}", " ", r.text()))


def comment_text(source: str) -> str:
    """Paragraphs one empty line apart, code fenced, emphasis and links in Markdown."""
    r = _Renderer({"p": "\n\n"}, {}, _COMMENT)
    r.feed(source)
    return r.text().strip()


html_to_text, comment_markdown = mapped(body_text), mapped(comment_text)


# --- wikitext --------------------------------------------------------------------------------------------------------

#: Link prefixes of media and categories, which go with their captions.
MEDIA = ("file", "image", "category", "dosya", "resim", "kategori")
#: Templates of listings, and of sources.
LISTINGS, SOURCES = ("see", "do", "eat", "buy", "drink", "sleep", "go", "listing"), ("source",)
#: What projects do with headings: bare, marked alike, or marked by level.
HEADINGS = {"source": None, "dictionary": "##", "quote": "##", "books": "##", "versity": "##", "voyage": "level", "news": "##", "species": "##"}
_OPENERS = re.compile(r"<!--|<ref\b[^>]*?/>|<ref\b|\{\||\{\{|\[\[|\[(?=(?:https?|ftp)://)|<(?:syntaxhighlight|source)\b")
_PAIRS = {"{{": "}}", "{|": "|}", "[[": "]]"}


def _closing(text: str, at: int, opening: str) -> int:
    """Where the pair that opens before ``at`` is closed, nested pairs counted; the text's end if it is not."""
    closing, depth = _PAIRS[opening], 1
    for m in re.finditer(f"{re.escape(opening)}|{re.escape(closing)}", text[at:]):
        depth += 1 if m[0] == opening else -1
        if not depth:
            return at + m.start()
    return len(text)


def _arguments(inner: str) -> tuple[str, dict[str, str], list[str]]:
    """Name, named and plain arguments of a template, cut at bars outside of nested pairs."""
    parts, depth, last = [], 0, 0
    for m in re.finditer(r"\{\{|\}\}|\[\[|\]\]|\|", inner):
        depth += 1 if m[0] in ("{{", "[[") else -1 if m[0] in ("}}", "]]") else 0
        if m[0] == "|" and depth <= 0:
            parts.append(inner[last : m.start()])
            last = m.end()
    parts.append(inner[last:])
    keyed, plain = {}, []
    for p in parts[1:]:
        key, eq, value = p.partition("=")
        if eq:
            keyed[key.strip().lower()] = value.strip()
        else:
            plain.append(p.strip())
    return parts[0].strip(), keyed, plain


def _template(inner: str, project: str) -> str:
    name, keyed, plain = _arguments(inner)
    low = name.lower()
    if project == "species" and not keyed and not plain and "{" not in inner:
        return name
    if project == "voyage" and low in LISTINGS:
        if not (title := wiki_plain(keyed.get("name", ""), "source")):
            return ""
        place = wiki_plain(keyed.get("address", ""), "source")
        said = wiki_plain(keyed.get("content") or keyed.get("description", ""), "source")
        return f" - **{title}**" + (f" ({place})" if place else "") + (f" {said}" if said else "")
    if project == "news" and low in SOURCES:
        facts = [wiki_plain(keyed.get(k, ""), "source") for k in ("author", "title", "pub", "date")]
        return "Source: " + ", ".join(f for f in facts if f)
    return ""


def _scanned(text: str, project: str, code: list[str]) -> str:
    """``text`` without comments, references, tables and templates; links by their labels, code as placeholders."""
    out, at = [], 0
    while m := _OPENERS.search(text, at):
        out.append(text[at : m.start()])
        mark, at = m[0], m.end()
        if mark == "<!--":
            end = text.find("-->", at)
            at = len(text) if end < 0 else end + 3
        elif mark.startswith("<ref"):
            if not mark.endswith("/>"):
                end = text.lower().find("</ref>", at)
                at = len(text) if end < 0 else end + 6
        elif mark in ("{{", "{|"):
            end = _closing(text, at, mark)
            out.append(_template(text[at:end], project) if mark == "{{" else "")
            at = min(len(text), end + 2)
        elif mark == "[[":
            end = _closing(text, at, mark)
            inner = text[at:end]
            at = min(len(text), end + 2)
            if inner.split(":")[0].strip().lower() not in MEDIA or ":" not in inner:
                out.append(_scanned(inner.rpartition("|")[2], project, code).strip())
        elif mark == "[":
            end = text.find("]", at)
            end = len(text) if end < 0 else end
            out.append(_scanned(text[at:end].partition(" ")[2], project, code))
            at = min(len(text), end + 1)
        else:
            tag = mark[1:]
            end = text.find(f"</{tag}>", at)
            head, close, body = text[at : len(text) if end < 0 else end].partition(">")
            at = len(text) if end < 0 else end + len(tag) + 3
            lang = re.search(r"lang=\"?([\w+-]+)", head)
            if close and project in ("books", "versity"):
                out.append(f"\n\x00{len(code)}\x00\n")
                code.append(f"```{lang[1] if lang else ''}\n{body.strip()}\n```")
            else:
                out.append(body)
    return "".join([*out, text[at:]])


def _wiki_line(line: str, project: str) -> str:
    style = HEADINGS[project]
    if h := re.fullmatch(r"\s*(={1,6})\s*(.+?)\s*={1,6}\s*", line):
        level = min(len(h[1]), 4) if style == "level" else 0
        return h[2] if style is None else f"{'#' * level if level else style} {h[2]}"
    if project == "quote" and (b := re.match(r"\*+", line)):
        return "  " * (len(b[0]) - 1) + "- " + line[len(b[0]) :].strip()
    kept = line.rstrip() if project == "quote" else line.strip()
    return re.sub(r"(?<=\S)[ \t]{2,}", " ", kept)


def wiki_plain(text: str, project: str = "source") -> str:
    code: list[str] = []
    text = _scanned(text, project, code)
    text = re.sub(r"<br\s*/?>", "\n", text, flags=re.I)
    text = re.sub(r"'{2,5}", "", re.sub(r"</?[A-Za-z][^>]*>", "", text))
    text = _settled("\n".join(_wiki_line(line, project) for line in html.unescape(text).split("\n")))
    return re.sub(r"\x00(\d+)\x00", lambda m: code[int(m[1])], text)


def wiki_text(c: Column, project: str = "source") -> Column:
    """Wikitext as plain text: comments, references, tables, templates, media and categories go; links keep their labels."""
    return mapped(lambda x: wiki_plain(x, project))(c)


# --- books, memos, transcripts -----------------------------------------------------------------------------------------

#: The marks around a book, with "the" or "this" or neither, and what editors put in.
BOOK_MARK = r"\*\*\* *{} +OF +(?:TH(?:E|IS) +)?PROJECT +GUTENBERG +EBOOK"
NOTE = re.compile(r"\[(?:transcriber|producer|editor|illustrator)['s]*\s+note", re.I)
PAGE_MARK = re.compile(r"\[(?:pg|page)\s+\d+\]", re.I)
LEAST_BOOK_WORDS = 200


def book_body(text: str) -> str:
    """A public-domain book without its envelope, notes, page marks, dividers and leaked markup."""
    lines = text.replace("\r\n", "\n").replace("\f", "\n").split("\n")
    start, stop = (re.compile(BOOK_MARK.format(w), re.I) for w in ("START", "END"))
    first = next((k + 1 for k, line in enumerate(lines) if start.search(line)), 0)
    last = next((k for k, line in enumerate(lines) if k >= first and stop.search(line)), len(lines))
    out, note = [], False
    for line in lines[first:last]:
        note = (note or bool(NOTE.search(line))) and bool(line.strip())
        if note or re.fullmatch(r"[ *\-=]{5,}", line):
            out.append("")
        else:
            out.append(re.sub(r"<[^>]{1,80}>", "", PAGE_MARK.sub("", line)))
    return _settled("\n".join(out))


@F.pandas_udf(StringType())
def decoded(s: pd.Series) -> pd.Series:
    """Bytes as UTF-8, or where they are none as Latin-1."""

    def text(b: bytes) -> str:
        try:
            return bytes(b).decode("utf-8")
        except UnicodeDecodeError:
            return bytes(b).decode("latin-1")

    return s.map(lambda b: None if b is None else text(b))


book_text = mapped(book_body)


def memo_body(text: str) -> str:
    """A memo without page feeds, page footers and the running head that follows one."""
    out, after_footer = [], False
    for line in text.replace("\r\n", "\n").replace("\f", "\n\n").split("\n"):
        if re.search(r"\S.*\[Page \d+\]\s*$", line):
            after_footer = True
        elif after_footer and not line.strip():
            continue
        elif after_footer and re.match(r"RFC \d+", line):
            after_footer = False
        else:
            after_footer = False
            out.append(line)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip()


rfc_text = mapped(memo_body)

#: What is marked as sound in captions.
SOUNDS = "music müzik applause alkış laughter gülüşmeler"
MORE_SOUNDS = f"{SOUNDS}|çalan müzik|kahkaha|cheering|cough|sigh|sound effect|inaudible"


def transcript_segment(c: Column) -> Column:
    """A caption without sound marks, notes and speaker prompts, blanks as one."""
    every, few = MORE_SOUNDS.replace(" ", "|", SOUNDS.count(" ")), SOUNDS.replace(" ", "|")
    c = F.regexp_replace(c, rf"(?iu)\[\s*(?:{every})[^\]]*\]|\(\s*(?:{few})[^)]*\)|[♪♫#]", "")
    c = F.regexp_replace(F.regexp_replace(F.ltrim(c), r"^>>\s*", ""), r"^[A-Z0-9_\s]{2,15}:\s*", "")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def transcript(segments: Column, form: str = "text") -> Column:
    """Cleaned segments that are not empty: as a list, or as one string."""
    kept = F.filter(F.transform(segments, transcript_segment), lambda x: x != "")
    return kept if form == "list" else F.array_join(kept, " ")
