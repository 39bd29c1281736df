"""Markup in texts: which kinds there are, and the text without it.

Each notation has a scanner that turns a text into events (a tag, a command with its arguments, a template, a pair of
emphasis signs), with a stack where signs nest. What a scanner has events of is a kind of markup in the text, and the
clean text is put together from the same events.

HTML goes through the standard library's parser event by event; each output line knows how much text and how many
tags it held. The text-to-tag ratios are smoothed with a Gaussian, and lines whose smoothed ratio lies below a
threshold taken from their spread are navigation and the like, not content. Kept structure comes out in one plain
notation: `# ` headings by level, `- ` list items, ``` code blocks, $ formulas $ and cells joined by ` | `.
"""

from __future__ import annotations

import html
import html.entities
import html.parser
import math
import re
from collections.abc import Iterator
from statistics import pstdev

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("html", "markdown", "wiki", "latex")
#: Gaussian width in lines; a line is content if its smoothed ratio reaches this share of the standard deviation.
SIGMA, THRESHOLD = 1.0, 0.5

#: Element names, wiki metadata prefixes, LaTeX commands that take no argument.
ELEMENTS = "a abbr acronym address article aside audio b base bdi bdo big blockquote body br button canvas caption center cite code col colgroup data datalist dd del details dfn dialog dir div dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark math menu meta meter mfrac mi mn mo mrow msqrt msub msup mtext nav noscript object ol optgroup option output p param picture pre progress q rp rt ruby s samp script search section select slot small source span strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr"
METADATA = "category file image template portal wikipedia special"
SYMBOLS = "ldots cdots dots cdot times pm mp le leq ge geq ne neq approx equiv sim infty partial nabla sum prod int to rightarrow leftarrow alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau phi chi psi omega Gamma Delta Theta Lambda Sigma Phi Psi Omega item hline noindent par newline maketitle quad qquad centering bf it sc tt em rm sf small large Large LaTeX TeX"

_TAG = rf"(?i:</?(?:{'|'.join(sorted(ELEMENTS.split(), key=len, reverse=True))})(?:\s+[a-z_:][\w:.-]*\s*=\s*(?:\"[^\"<>]*\"|'[^'<>]*'|[^\s\"'<>]+)|\s+(?:hidden|disabled|checked|selected|required|readonly|multiple|async|defer|open|controls|nowrap))*\s*/?>)"
_HTML_SIGN = re.compile(rf"{_TAG}|<!--.*?-->|(?i:<!doctype[^<>]*>)|&(?:#\d{{1,7}}|#[xX][0-9a-fA-F]{{1,6}}|[A-Za-z][A-Za-z0-9]{{1,30}});", re.S)
#: Any text with markup has one of these signs, or a line that names its metadata.
_ANY = re.compile(rf"[<&\\*_~`\[\]{{}}$#|>=+]|''|^[ ]{{0,3}}(?:-|\d{{1,3}}[.)])[ ]|^-{{3}}|(?i:^[ \t]*(?:{METADATA.replace(' ', '|')})[ \t]*:)", re.M)


class _Reader(html.parser.HTMLParser):
    """Lines of text with the number of characters, linked characters and tags of each; `events` counts what was read as
    HTML."""

    BLOCKS = frozenset("address article aside blockquote body br caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section table tbody tfoot thead title tr ul".split())
    HIDDEN = frozenset("script style template noscript".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.lines: list[list] = [["", 0, 0, False]]  # text, linked characters, tags, structural
        self.hidden = self.linked = self.pre = self.events = 0
        self.after_link = False
        self.lists: list[list] = []

    def handle_entityref(self, name: str) -> None:
        self.events += 1
        self._text(html.unescape(f"&{name};"))

    def handle_charref(self, name: str) -> None:
        self.events += 1
        self._text(html.unescape(f"&#{name};"))

    def handle_comment(self, data: str) -> None:
        self.events += 1

    def handle_decl(self, decl: str) -> None:
        self.events += 1

    def _line(self, prefix: str = "", keep: bool = False) -> None:
        last = self.lines[-1]
        if last[0].strip():
            self.lines.append([prefix, 0, 0, keep])
        else:
            last[0] = prefix or last[0]
            last[3] = last[3] or keep

    def handle_starttag(self, tag: str, attrs) -> None:
        self.events += 1
        self.lines[-1][2] += 1
        if tag in self.HIDDEN:
            self.hidden += 1
        elif tag == "a":
            if self.after_link and self.lines[-1][0] and not self.lines[-1][0][-1].isspace():
                self.lines[-1][0] += " "
            self.linked += 1
        elif tag[0] == "h" and tag[1:].isdigit():
            self._line("#" * int(tag[1]) + " ", True)
        elif tag in ("ul", "ol"):
            self._line()
            self.lists.append([tag, 0])
        elif tag == "li":
            if self.lists:
                self.lists[-1][1] += 1
            mark = f"{self.lists[-1][1]}. " if self.lists and self.lists[-1][0] == "ol" else "- "
            self._line(mark)
        elif tag == "dt":
            self._line()
        elif tag == "dd":
            self._line("- ")
        elif tag == "pre":
            self._line()
            self.lines[-1][0] = "```"
            self.lines[-1][3] = True
            self.lines.append(["", 0, 0, True])
            self.pre += 1
        elif tag in ("td", "th"):
            if self.lines[-1][0].strip():
                self.lines[-1][0] += " | "
        elif tag == "math":
            self.lines[-1][0] += "$"
        elif tag in self.BLOCKS:
            self._line()

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag in self.HIDDEN or tag in ("a", "pre", "ul", "ol", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.events += 1
        self.lines[-1][2] += 1
        self.after_link = tag == "a"
        if tag in self.HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif tag == "a":
            self.linked = max(0, self.linked - 1)
        elif tag in ("ul", "ol"):
            if self.lists:
                self.lists.pop()
            self._line()
        elif tag == "pre" and self.pre:
            self.pre -= 1
            self._line("```", True)
            self.lines.append(["", 0, 0, False])
        elif tag == "math":
            self.lines[-1][0] += "$"
        elif tag in self.BLOCKS or tag[0] == "h" and tag[1:].isdigit():
            self._line()

    def handle_data(self, data: str) -> None:
        self._text(data.replace(_LESS, "<").replace(_AND, "&"))

    def _text(self, data: str) -> None:
        if self.hidden or not data:
            return
        self.after_link = False
        for k, part in enumerate(data.split("\n")):
            if k:
                # a line end of the source is one of the text, too, but blank lines are kept once at most
                self.lines.append(["", 0, 0, self.pre > 0])
            self.lines[-1][0] += part
            if self.linked:
                self.lines[-1][1] += len(part)


def _content(lines: list[list]) -> list[str]:
    """Lines of the content regions: text-to-tag ratio, smoothed, against a threshold from its spread."""
    at = [k for k, x in enumerate(lines) if x[0].strip()]
    ratio = [max(0, len(lines[k][0]) - 2 * lines[k][1]) / (1 + lines[k][2]) for k in at]
    if len(at) < 3:
        return [x[0] for x in lines]
    radius = max(1, math.ceil(2 * SIGMA))
    kernel = [math.exp(-d * d / (2 * SIGMA * SIGMA)) for d in range(-radius, radius + 1)]
    smooth = []
    for k in range(len(ratio)):
        near = [(kernel[d + radius], ratio[k + d]) for d in range(-radius, radius + 1) if 0 <= k + d < len(ratio)]
        smooth.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    limit = min(THRESHOLD * pstdev(smooth), 20.0)
    # only lines that are mostly links or bare of text are ever dropped; a region of them ends where text begins
    weak = [r < limit and not lines[i][3] and (lines[i][1] * 2 > len(lines[i][0]) or lines[i][2] > 4) for i, r in zip(at, ratio)]
    drop: set[int] = set()
    for order in (range(len(at)), range(len(at) - 1, -1, -1)):
        inside = False
        for k in order:
            # a line of several links and nothing else needs no neighbours to tell
            inside = weak[k] and (inside or smooth[k] < limit or (ratio[k] == 0 and lines[at[k]][2] >= 4))
            if inside:
                drop.add(at[k])
    return [x[0] for k, x in enumerate(lines) if k not in drop]


#: Stand for signs that aren't HTML while the parser runs.
_LESS, _AND = "\ue000", "\ue001"


def scan_html(text: str) -> tuple[str, int]:
    """(text, events). Signs that are no tags or entities, such as "a<b" and "R&D", don't reach the parser as such."""
    parts, last = [], 0
    for m in _HTML_SIGN.finditer(text):
        sign = m.group()
        if sign[0] == "&" and sign[1] != "#" and sign[1:] not in html.entities.html5:
            continue
        parts += [text[last : m.start()].replace("<", _LESS).replace("&", _AND), sign]
        last = m.end()
    if not parts:
        return text, 0
    parts.append(text[last:].replace("<", _LESS).replace("&", _AND))
    reader = _Reader()
    reader.feed("".join(parts))
    reader.close()
    return "\n".join(_content(reader.lines)), reader.events


def _closing(text: str, signs: re.Pattern, closers: dict[str, str]) -> dict[int, int]:
    """Where each opening sign that is closed in order has its closing one."""
    stack: list[tuple[str, int]] = []
    out = {}
    for m in signs.finditer(text):
        sign = m.group()
        if sign in closers:
            stack.append((closers[sign], m.start()))
        elif any(want == sign for want, _ in stack):
            while True:  # what was opened inside and never closed is no pair
                want, at = stack.pop()
                if want == sign:
                    out[at] = m.start()
                    break
    return out


class _Latex:
    SIGN = re.compile(r"\\begin\{(verbatim|lstlisting|equation|align|math|displaymath|tabular)(\*?)\}|\\([A-Za-z]+)\*?|\\([^A-Za-z])|\$\$?|\{|``|~")
    BRACES = re.compile(r"(?<!\\)[{}]")
    OPTION = re.compile(r"(?:\[[^\]\n]*\])?")
    INLINE = re.compile(r"(?![^$\n]*[^\W\d_]{3,}[ ])\$(?=[^\s$])([^$\n]*[\\^_{}=+][^$\n]*)(?<=[^\s$])\$(?!\d)")
    QUOTE = re.compile(r"``([^`'\n]+)''")
    SWITCH = re.compile(r"\{\\(?:bf|it|sc|tt|em|rm|sf|small|large|Large)\s+")
    NAMES = frozenset(SYMBOLS.split())
    LEVELS = {"chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5, "subparagraph": 6}
    SILENT = frozenset("label ref eqref pageref index footnotemark begin end vspace hspace usepackage documentclass includegraphics bibliographystyle bibliography".split())
    LAST = frozenset("href textcolor colorbox hyperref".split())
    GONE = frozenset("hline noindent par newline maketitle quad qquad centering bf it sc tt em rm sf small large Large".split())

    def __init__(self, text: str):
        self.text, self.events = text, 0
        self.close = _closing(text, self.BRACES, {"{": "}"})

    def render(self, start: int, end: int) -> str:
        text, out, i = self.text, [], start
        while m := self.SIGN.search(text, i, end):
            out.append(text[i : m.start()])
            piece, i = self.sign(m, end)
            out.append(piece)
        out.append(text[i:end])
        return "".join(out)

    def formula(self, body: str) -> str:
        self.events += 1
        return f"${body.strip()}$"

    def sign(self, m: re.Match, end: int) -> tuple[str, int]:
        text, raw, s, e = self.text, m.group(), m.start(), m.end()
        if m.group(1):
            return self.environment(m, end)
        if m.group(3):
            return self.command(m, end)
        if raw in ("\\(", "\\["):
            stop = text.find("\\)" if raw[1] == "(" else "\\]", e, end)
            return (self.formula(text[e:stop]), stop + 2) if stop > e else (raw, e)
        if raw == "\\\\":
            return ("", e) if text[e : e + 1] in ("", "\n") else ("\n", e)
        if raw[0] == "\\":
            if raw[1] not in "%&#_${}":
                return raw, e
            if not (text[e : e + 1].isalnum() or text[e : e + 1] in ("_", "\\")) or not text[e : e + 1]:
                self.events += 1
            return raw[1], e
        if raw == "$$":
            stop = text.find("$$", e, end)
            return (self.formula(text[e:stop]), stop + 2) if stop > e and "$" not in text[e:stop] else (raw, e)
        if raw == "$":
            f = self.INLINE.match(text, s, end) if not s or not (text[s - 1].isalnum() or text[s - 1] in "_$") else None
            return (self.formula(f.group(1)), f.end()) if f else (raw, e)
        if raw == "{":
            w = self.SWITCH.match(text, s, end)
            if w and self.close.get(s, end) < end:
                self.events += 1
                return self.render(w.end(), self.close[s]), self.close[s] + 1
            return raw, e
        if raw == "``":
            q = self.QUOTE.match(text, s, end)
            if q:
                self.events += 1
                return f'"{self.render(*q.span(1))}"', q.end()
            return raw, e
        after, before = text[e : e + 1], text[s - 1 : s]
        blank = not after or after.isspace() or (before and not before.isspace() and (after.isalnum() or after in "_\\"))
        return (" " if blank else raw), e

    def environment(self, m: re.Match, end: int) -> tuple[str, int]:
        text, name, e = self.text, m.group(1), m.end()
        closing = f"\\end{{{name}{m.group(2)}}}"
        stop = text.find(closing, e, end)
        self.events += 1
        if stop < 0:
            return "", e
        if name in ("verbatim", "lstlisting"):
            return "```\n" + text[e:stop].strip("\n") + "\n```", stop + len(closing)
        if name != "tabular":
            return self.formula(re.sub(r"\\label\{[^}]*\}", "", text[e:stop])), stop + len(closing)
        e = self.OPTION.match(text, e).end()
        if text[e : e + 1] == "{" and e in self.close:
            e = self.close[e] + 1
        rows, at = [], e
        for row in re.split(r"(\\\\)", text[e:stop]):
            if row != "\\\\":
                cells, c = [], at
                for cell in re.split(r"((?<!\\)&)", row):
                    if cell != "&":
                        cells.append(self.render(c, c + len(cell)).strip())
                    c += len(cell)
                rows.append(" | ".join(cells))
            at += len(row)
        return "\n".join(r for r in rows if r), stop + len(closing)

    def command(self, m: re.Match, end: int) -> tuple[str, int]:
        text, name, s, e = self.text, m.group(3), m.start(), m.end()
        at, args = self.OPTION.match(text, e).end(), []
        if text[at : at + 1] == "{":
            self.events += 1
            if self.close.get(at, end) >= end:
                return "", at
            while text[at : at + 1] == "{" and self.close.get(at, end) < end:
                args.append((at + 1, self.close[at]))
                at = self.close[at] + 1
            if name in self.SILENT or name.startswith("cite"):
                return "", self.OPTION.match(text, at).end()
            if name in self.LEVELS:
                return f"\n{'#' * self.LEVELS[name]} {self.render(*args[0]).strip()}\n" + "".join(self.render(*a) for a in args[1:]), at
            if name == "item":
                return self.item(s) + "".join(self.render(*a) for a in args), at
            if name == "frac" and len(args) > 1:
                return "/".join(self.render(*a) for a in args), at
            if name in self.LAST:
                return self.render(*args[-1]), at
            if name in ("ldots", "dots"):
                return "…", at
            return " ".join(self.render(*a) for a in args), at
        before, after = text[s - 1 : s], text[e : e + 1]
        if name not in self.NAMES or before.isalnum() or before in ("_", ":", "\\") and before or after == "/":
            return m.group(), e
        self.events += 1
        if name == "item":
            at = self.OPTION.match(text, e).end()
            while text[at : at + 1] in (" ", "\t"):
                at += 1
            return self.item(s), at
        if name in self.GONE:
            return "", e
        return {"ldots": "…", "dots": "…", "LaTeX": "LaTeX", "TeX": "TeX"}.get(name, m.group()), e

    def item(self, at: int) -> str:
        """A list item, on a line of its own."""
        line = self.text[self.text.rfind("\n", 0, at) + 1 : at]
        return "\n- " if line.strip() else "- "


def scan_latex(text: str) -> tuple[str, int]:
    if "\\" not in text and "$" not in text and "``" not in text:
        return text, 0
    scanner = _Latex(text)
    return scanner.render(0, len(text)), scanner.events


class _Wiki:
    SIGN = re.compile(r"\{\{|\[\[|\[(?=(?:https?:|ftp:)?//)|__[A-Z]{3,}__|~{3,}|(?i:<ref\b[^<>/]*>.*?</ref\s*>)|(?i:</?(?:ref|nowiki|gallery|references)\b[^<>]*>)", re.S)
    PAIRS = re.compile(r"\{\{|\}\}|\[\[|\]\]")
    LINK = re.compile(r"\[(?:https?:|ftp:)?//[^\s\]]+(?: ([^\]\n]*))?\]")
    OUT = re.compile(r"(?i)\s*(?:file|image|category)\s*:")
    WORD = re.compile(r"(?i)lang\|[^|{}]*\|")
    HEAD = re.compile(r"^(={2,6})[ \t]*([^=\s][^=\n]*?)[ \t]*={2,6}[ \t]*$", re.M)
    LINES = re.compile(rf"(?im)^[ \t]*(?:{METADATA.replace(' ', '|')})[ \t]*:[ \t]*\S[^\n]*$|^\#redirect\b[^\n]*$")
    FRAME = re.compile(r"(?m)^\{\|[^\n]*$|^\|-(?:[ \t][^|\n]*)?$|^\|\}[^\n]*$")
    CELLS = re.compile(r"(?m)^[|!](?![|}-])[ \t]*(?=\S)[^\n]*$")
    MARKS = re.compile(r"'{2,}")

    def __init__(self, text: str):
        self.text, self.events = text, 0
        self.close = _closing(text, self.PAIRS, {"{{": "}}", "[[": "]]"})

    def render(self, start: int, end: int) -> str:
        text, out, i = self.text, [], start
        while m := self.SIGN.search(text, i, end):
            out.append(text[i : m.start()])
            piece, i = self.sign(m, end)
            out.append(piece)
        out.append(text[i:end])
        return "".join(out)

    def sign(self, m: re.Match, end: int) -> tuple[str, int]:
        text, raw, s, e = self.text, m.group(), m.start(), m.end()
        stop = self.close.get(s, end)
        if raw == "{{":
            if stop >= end or stop == e:
                return raw, e
            self.events += 1
            w = self.WORD.match(text, e, stop)
            return (self.render(w.end(), stop) if w else ""), stop + 2
        if raw == "[[":
            if stop >= end or stop == e or "\n" in text[e:stop]:
                return raw, e
            self.events += 1
            if self.OUT.match(text, e, stop):
                return "", stop + 2
            inside = self.render(e, stop)
            return inside.rsplit("|", 1)[-1], stop + 2
        if raw == "[":
            link = self.LINK.match(text, s, end)
            if not link:
                return raw, e
            self.events += 1
            return link.group(1) or "", link.end()
        if raw[0] == "~":
            line = text[e : end if (k := text.find("\n", e, end)) < 0 else k]
            # three at the start of a line may open a code block of another notation
            if len(raw) > 5 or len(raw) == 3 and "`" not in line and k >= 0:
                return raw, e
            self.events += 1
            return "", e
        self.events += 1
        return "", e

    def marks(self, text: str) -> str:
        """Without pairs of quote runs for emphasis, line by line; what opens last closes first."""
        if "''" not in text:
            return text
        lines = text.split("\n")
        for k, line in enumerate(lines):
            stack: list[tuple[int, int]] = []
            gone: list[tuple[int, int]] = []
            for m in self.MARKS.finditer(line):
                before, after = line[m.start() - 1 : m.start()], line[m.end() : m.end() + 1]
                opens = not (before.isalnum() or before in ("_", "`") and before) and after and not after.isspace()
                closes = before and not before.isspace() and not (after.isalnum() or after == "_")
                if closes and stack:
                    gone += [stack.pop(), m.span()]
                elif opens:
                    stack.append(m.span())
            self.events += len(gone) // 2
            for s, e in sorted(gone, reverse=True):
                line = line[:s] + line[e:]
            lines[k] = line
        return "\n".join(lines)

    def whole(self) -> str:
        def counted(new):
            def put(m: re.Match) -> str:
                self.events += 1
                return new(m)

            return put

        out = self.LINES.sub(counted(lambda m: ""), self.render(0, len(self.text)))
        out = self.HEAD.sub(counted(lambda m: "#" * len(m.group(1)) + " " + m.group(2)), out)
        framed = self.events
        out = self.FRAME.sub(counted(lambda m: ""), out)
        if self.events > framed:
            out = self.CELLS.sub(lambda m: re.sub(r"\s*(?:\|\||!!)\s*", " | ", re.sub(r"^[|!][ \t]*", "", m.group())), out)
        return self.marks(out)


def scan_wiki(text: str) -> tuple[str, int]:
    scanner = _Wiki(text)
    return scanner.whole(), scanner.events


class _Markdown:
    FENCE = re.compile(r"[ ]{0,3}(```|~~~)[^`\n]*$")
    HEAD = re.compile(r"(#{1,6})[ \t]+(?!\d+(?:\s|$))(?=\S)")
    UNDER = re.compile(r"(={3,}|-{3,})[ \t]*$")
    RULE = re.compile(r"\s*\|?\s*:?-{3,}:?\s*(?:\|\s*:?-{2,}:?\s*)+\|?\s*$")
    TASK = re.compile(r"(\s*)[-*+] \[[ xX]\] ")
    BULLET, NUMBER = re.compile(r"[ ]{0,3}([-*+])[ ]\S"), re.compile(r"[ ]{0,3}\d{1,3}[.)][ ]\S")
    STARRED = re.compile(r"(\s*)[*+][ ](?=\S)")
    QUOTED = re.compile(r">[ ]+(?=\S)")
    NOTE = re.compile(r"\[\^?[^\]\n]+\]:[ \t]+(?=\S)(?:\S+$)?")
    SPAN = re.compile(r"\$[^$\n]+\$|(?<!`)`(?!`)([^`\n]+)`(?!`)|!\[([^\]\n]*)\]\([^)\s]*\)|(?<![\w\]!])\[([^\[\]\n]+)\]\([^()\s]+\)|(?<![\w\]\[])\[([^\[\]\n]+)\]\[[^\[\]\n]*\](?!\])|\[\^[^\]\s]+\]")
    MARK = re.compile(r"(?<![*\\])\*{1,3}(?!\*)|(?<!_)_{1,3}(?!_)|(?<!~)~~(?!~)")

    def __init__(self) -> None:
        self.events = 0

    def spans(self, line: str) -> str:
        """Links, images, notes and code of a line; formulas pass through."""

        def put(m: re.Match) -> str:
            if m.group()[0] == "$":
                return m.group()
            self.events += 1
            return next((g for g in m.groups() if g is not None), "")

        return self.SPAN.sub(put, line) if "`" in line or "[" in line else line

    def emphasis(self, line: str) -> str:
        """Without pairs of emphasis signs; a stack pairs each sign with the last open one of its kind."""
        stack: list[tuple[str, int, int]] = []
        gone: list[tuple[int, int]] = []
        kept = [m.span() for m in re.finditer(r"\$[^$\n]+\$", line)] if "$" in line else []
        for m in self.MARK.finditer(line):
            sign, s, e = m.group(), m.start(), m.end()
            if any(a <= s < b for a, b in kept):
                continue
            before, after = line[s - 1 : s], line[e : e + 1]
            word_before, word_after = before.isalnum() or before == "_", after.isalnum() or after == "_"
            closes = before and not before.isspace() and not word_after and not (sign == "*" and before == "(")
            if closes and any(x == sign for x, _, _ in stack):
                while True:
                    x, a, b = stack.pop()
                    if x == sign:
                        break
                gone += [(a, b), (s, e)]
            elif sign == "~~" and after and not after.isspace():
                stack.append((sign, s, e))
            elif not word_before and before != "\\" and after and not after.isspace() and (len(sign) > 1 or word_after or after in "*_"):
                if sign == "__" and re.match(r"[A-Z]+__", line[e:]):
                    continue
                stack.append((sign, s, e))
        self.events += len(gone) // 2
        for s, e in sorted(gone, reverse=True):
            line = line[:s] + line[e:]
        return line

    def render(self, text: str) -> str:
        lines, out, fence, items = text.split("\n"), [], None, None
        for k, line in enumerate(lines):
            m = self.FENCE.match(line)
            if fence or m:
                if m and (fence is None or m.group(1) == fence):
                    self.events += 1
                    fence = None if fence else m.group(1)
                    line = "```"
                out.append(line)
                continue
            # two items on lines that follow each other make a list
            b = self.BULLET.match(line)
            item = b.group(1) if b else "1" if self.NUMBER.match(line) else None
            if item and item == items:
                self.events += 1
            items = item
            if (u := self.UNDER.match(line)) and k and re.search(r"\w", lines[k - 1]) and out and out[-1].strip():
                self.events += 1
                out[-1] = ("# " if u.group(1)[0] == "=" else "## ") + out[-1]
                continue
            if self.RULE.match(line):
                self.events += 1
                continue
            if line.startswith("#") and self.HEAD.match(line):
                self.events += 1
            for pattern, new in ((self.NOTE, ""), (self.QUOTED, "")):
                if m := pattern.match(line):
                    self.events += 1
                    line = new + line[m.end() :]
            if m := self.TASK.match(line):
                self.events += 1
                line = m.group(1) + "- " + line[m.end() :]
            elif m := self.STARRED.match(line):
                line = m.group(1) + "- " + line[m.end() :]
            line = self.spans(line)
            if "*" in line or "_" in line or "~~" in line:
                line = self.emphasis(line)
            out.append(re.sub(r"^\s*\|[ \t]*(.*?)[ \t]*\|[ \t]*$", r"\1", line) if line.count("|") > 1 else line)
        return "\n".join(out)


def scan_markdown(text: str) -> tuple[str, int]:
    scanner = _Markdown()
    return scanner.render(text), scanner.events


_SCANNERS = (("html", scan_html), ("latex", scan_latex), ("wiki", scan_wiki), ("markdown", scan_markdown))


def clean(text: str | None) -> tuple[str | None, list[str]]:
    """(text without markup, its kinds). Text without markup, NULL included, comes back as it is.

    A notation is in the text if its scanner has events of it; the scanners of those found then rewrite the text in
    turn, so that what one makes plain isn't taken for markup of another."""
    if not text or not _ANY.search(text):
        return text, []
    first = {kind: scan(text) for kind, scan in _SCANNERS}
    found = [kind for kind in KINDS if first[kind][1]]
    if not found:
        return text, found
    out = None
    for kind, scan in _SCANNERS:
        if kind in found:
            out = first[kind][0] if out is None else scan(out)[0]
    out = re.sub(r"[ \t]+$", "", out, flags=re.M)
    return re.sub(r"\n{3,}", "\n\n", out).strip(), found


def kinds(text: str | None) -> list[str]:
    """Kinds of markup in the text, in the order of KINDS."""
    return clean(text)[1]


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [clean(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t for t, _ in rows], pa.string()), pa.array([k for _, k in rows], pa.list_(pa.string()))], names=["id", "clean_text", "kinds"])


def cleaned(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`id, clean_text, kinds` of every row; NULL stays NULL with no kinds."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_run, f"id {rows.schema['id'].dataType.simpleString()}, clean_text string, kinds array<string>")
