"""Equation scripts of word-processor files as LaTeX: a tokenizer and a recursive parser."""

from __future__ import annotations

import re

from corpusloom.convert.hwpx import normal_text

#: Script words and the LaTeX they stand for.
SYMBOLS = {
    "Isum": r"\sum", "sum": r"\sum", "prod": r"\prod", "int": r"\int", "TIMES": r"\times", "times": r"\times",
    "LEQ": r"\le", "GEQ": r"\ge", "NEQ": r"\ne", "leq": r"\le", "geq": r"\ge", "neq": r"\ne",
    "MIN": r"\min", "MAX": r"\max", "Min": r"\min", "Max": r"\max", "min": r"\min", "max": r"\max",
    "ln": r"\ln", "log": r"\log", "exp": r"\exp", "vert": r"\mid", "alpha": r"\alpha", "beta": r"\beta",
    "gamma": r"\gamma", "delta": r"\delta", "DELTA": r"\Delta", "epsilon": r"\epsilon", "varepsilon": r"\varepsilon",
    "theta": r"\theta", "lambda": r"\lambda", "mu": r"\mu", "rho": r"\rho", "sigma": r"\sigma", "SIGMA": r"\Sigma",
    "phi": r"\phi", "omega": r"\omega", "prime": r"\prime",
}
SIGNS = {"≤": r"\le", "≥": r"\ge", "≠": r"\ne", "×": r"\times", "÷": r"\div", "±": r"\pm"}
COMPARISONS = {"=", "<", ">", r"\le", r"\ge", r"\ne", "≤", "≥", "≠", "LEQ", "GEQ", "NEQ", "leq", "geq", "neq"}
#: The heading of a text's equations, and how each block is named and fenced.
SECTION = "HWP 수식"
BLOCKS = (("원본(HWP EqEdit)", "hwp-equation", lambda script: script), ("LaTeX(best-effort)", "math", lambda script: equation_to_latex(script)))

_TOKEN = re.compile(r'"[^"]*"|\\[A-Za-z]+|\\[{}]|[A-Za-z]+|\d+(?:[.,]\d+)*|[가-힣ㄱ-ㆎ]+(?:[  ]*[`~][`~ ]*[가-힣]+)*|[^\s`~]')
_ONE = {"hat": r"\hat", "bar": r"\bar", "vec": r"\vec", "tilde": r"\tilde", "dot": r"\dot", "sqrt": r"\sqrt", "root": r"\sqrt", "under": r"\underline"}
_BODY = {"matrix", "dmatrix", "pmatrix", "bmatrix", "eqalign", "cases"}
_DELIMITERS = {"{": r"\{", "}": r"\}", "(": "(", ")": ")", "[": "[", "]": "]", "|": "|", "<": r"\langle", ">": r"\rangle", ".": "."}


def clean_script(script: str | None) -> str:
    """A script without unprintable characters, its white space collapsed."""
    return normal_text("".join(c if c.isprintable() and c != "�" else " " for c in script or ""))


class _Parser:
    def __init__(self, script: str):
        self.tokens = _TOKEN.findall(script)
        self.at = 0

    def peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def take(self) -> str:
        self.at += 1
        return self.tokens[self.at - 1]

    def sequence(self, ends: frozenset[str], cells: bool = False) -> list[str]:
        """Atoms up to one of ``ends`` (which stays), with infix fractions resolved."""
        atoms: list[str] = []
        slash = None
        while (token := self.peek()) and not (token in ends or token.upper() == "RIGHT" and "RIGHT" in ends):
            if token.lower() == "over" and atoms:
                self.take()
                start = self.numerator(atoms)
                below = self.denominator(ends)
                if start < len(atoms) and below:
                    atoms[start:] = [rf"\frac{{{_open(_join(atoms[start:]))}}}{{{below}}}"]
                else:
                    atoms.append(below)
            elif token == "/" and slash is None and atoms and not cells:
                self.take()
                slash = len(atoms)
            elif token == "#":
                self.take()
                atoms.append(r"\\")
            elif token == "}" and "}" not in ends:
                self.take()  # closes nothing
            else:
                atoms.append(self.scripted(ends) or "")
        if slash is not None and slash < len(atoms):
            # A division takes all of its group, but not what stands before a comparison.
            start = max((i + 1 for i in range(slash) if atoms[i] in COMPARISONS), default=0)
            stop = min((i for i in range(slash, len(atoms)) if atoms[i] in COMPARISONS), default=len(atoms))
            atoms[start:stop] = [rf"\frac{{{_join(atoms[start:slash])}}}{{{_join(atoms[slash:stop])}}}"]
        return [a for a in atoms if a]

    @staticmethod
    def numerator(atoms: list[str]) -> int:
        """Where an infix fraction begins: after the last sign that divides, or bracket that is still open;
        a comparison that would come first stays outside."""
        start, closed = len(atoms), 0
        while start and not (not closed and atoms[start - 1] in ("=", ",", "+", ";", "&", r"\\", "(", "[")):
            start -= 1
            closed += (atoms[start] in (")", "]")) - (atoms[start] in ("(", "["))
        return start + (start < len(atoms) - 1 and atoms[start] in (r"\le", r"\ge", r"\ne"))

    def denominator(self, ends: frozenset[str]) -> str:
        """A group in braces, or what follows up to a sign that divides or a closing bracket."""
        if self.peek() == "{":
            return _open(self.atom())
        parts, depth = [], 0
        while (token := self.peek()) and token not in ends and (depth or token not in ("TIMES", "times", "+", "-", "=", ",", ";", "&", "#", ")", "]")):
            depth += (token in "([") - (token in ")]")
            parts.append(self.scripted(ends) or "")
        return _join(parts)

    def scripted(self, ends: frozenset[str]) -> str | None:
        """One atom with its sub- and superscripts; repeated ones nest."""
        if not self.peek() or self.peek() in ends:
            return None
        base = "" if self.peek() in "_^" else self.atom()
        scripts: dict[str, list[str]] = {}
        while self.peek() in ("_", "^"):
            mark = self.take()
            scripts.setdefault(mark, []).append(_open(self.atom(in_script=True)) if self.peek() and self.peek() not in ends else "")
        for mark, parts in scripts.items():
            inner = parts[-1]
            for part in reversed(parts[:-1]):
                inner = f"{part}{mark}{{{inner}}}"
            base += f"{mark}{{{inner}}}"
        return base

    def group(self) -> str:
        """What stands in braces that were opened; a missing brace ends with the script."""
        inner = _join(self.sequence(frozenset("}")))
        if self.peek() == "}":
            self.take()
        return inner

    def body(self) -> list[list[str]]:
        """Rows and cells of a matrix or list of cases."""
        if self.peek() != "{":
            return [[self.scripted(frozenset()) or ""]]
        self.take()
        rows: list[list[str]] = [[]]
        while self.peek() and self.peek() != "}":
            rows[-1].append(_join(self.sequence(frozenset("}&#"), cells=True)))
            if self.peek() in ("&", "#"):
                if self.take() == "#":
                    rows.append([])
        if self.peek() == "}":
            self.take()
        return [r for r in rows if any(r)]

    def atom(self, in_script: bool = False) -> str:
        token = self.take()
        word = token.lower()
        if token.startswith('"'):
            return _literal(token[1:-1])
        if token == "{":
            return "{" + self.group() + "}"
        if word in _ONE and (self.peek() == "{" or word != "under"):
            return f"{_ONE[word]}{{{_open(self.atom() if self.peek() else '')}}}"
        if word in _BODY and self.peek() == "{":
            return _environment(word, self.body())
        if word == "left" and not in_script:
            opening = _DELIMITERS.get(self.take(), ".") if self.peek() else "."
            inner = _join(self.sequence(frozenset({"RIGHT"})))
            closing = "."
            if self.peek().upper() == "RIGHT":
                self.take()
                closing = _DELIMITERS.get(self.take(), ".") if self.peek() else "."
            return rf"\left{opening} {inner} \right{closing}"
        if word == "right":
            return rf"\right{_DELIMITERS.get(self.take(), '.') if self.peek() else '.'}"
        if re.match("[가-힣ㄱ-ㆎ]", token):
            return rf"\text{{{normal_text(re.sub('[`~]', ' ', token))}}}"
        return SYMBOLS.get(token) or SIGNS.get(token) or (r"\bar{r}" if token == "barr" else token)


def _open(atom: str) -> str:
    """An atom without the braces that hold all of it."""
    if atom.startswith("{") and atom.endswith("}"):
        depth = 0
        for i, char in enumerate(atom):
            depth += (char == "{") - (char == "}")
            if not depth:
                return atom[1:-1] if i == len(atom) - 1 else atom
    return atom


def _join(atoms: list[str]) -> str:
    text = " ".join(a for a in atoms if a)
    return re.sub(r" ([,;])", r"\1", re.sub(r" +", " ", text)).strip()


def _literal(value: str) -> str:
    value = normal_text(value.replace("`", " "))
    if value in ("{", "}"):
        return "\\" + value
    if re.fullmatch(r"[A-Za-z][A-Za-z0-9 ]*", value):
        return rf"\operatorname{{{value}}}"
    return rf"\text{{{value}}}" if value else ""


def _environment(word: str, rows: list[list[str]]) -> str:
    lines = [" & ".join(r) for r in rows]
    if word == "eqalign":
        return rf"\begin{{aligned}}{r' \\ '.join(lines)}\end{{aligned}}" if len(lines) > 1 else (lines or [""])[0]
    if word == "cases":
        spoken = [re.sub(r"\b(if|where)\b", r"\\text{ \1 }", " & ".join(r)) for r in rows]
        return rf"\begin{{cases}}{r' \\ '.join(spoken)}\end{{cases}}"
    if len(lines) == 1 and len(rows[0]) == 1:
        return (r"\displaystyle " if word == "dmatrix" else "") + lines[0]
    style = r"\displaystyle " if word == "dmatrix" else ""
    kind = "matrix" if word == "dmatrix" else word
    return rf"\begin{{{kind}}}{r' \\ '.join(style + x for x in lines)}\end{{{kind}}}"


def equation_to_latex(script: str | None) -> str:
    """LaTeX of an equation script; its braces balance whatever the script's do. Blank scripts give ``''``."""
    parser = _Parser(clean_script(script))
    latex = _join(parser.sequence(frozenset()))
    latex = re.sub(r"([A-Za-z0-9}])\s*([=<>+])\s*", r"\1 \2 ", latex)
    latex = re.sub(r"(?<=[A-Za-z0-9}])\s*-\s*(?=[A-Za-z0-9\\{])", " - ", latex)
    latex = re.sub(r"(\d) (?=[A-Za-z](?![A-Za-z]))", r"\1", latex)
    if "&" in latex and r"\begin" not in latex:
        latex = rf"\begin{{aligned}}{latex}\end{{aligned}}"
    return normal_text(latex) if "&" not in latex else " ".join(latex.split())


def with_equations(text: str | None, scripts: list[str] | None) -> str:
    """A text with a section of its equations: each script as it stands and as LaTeX. Blank scripts are dropped."""
    filled = [s for s in scripts or () if s and s.strip()]
    parts = [f"수식 {i} {name}:\n```{fence}\n{shown}\n```" for i, script in enumerate(filled, 1) for name, fence, show in BLOCKS if (shown := show(script))]
    return "\n\n".join([(text or "").rstrip(), f"## {SECTION}", *parts]) + "\n" if parts else text or ""
