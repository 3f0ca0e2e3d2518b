"""Regular expressions that Spark evaluates inside the JVM.

Everything here is a pattern *string*; no matching happens in Python.  Loops
are possessive so Java walks them iteratively and never deepens its stack, and
every lexer is total: the pieces of a text concatenate back to the text.
"""

from __future__ import annotations

import re

# How deep brackets may nest inside one bracket atom, angle brackets in a type, and
# block comments in Rust.  Deeper brackets are still lexed, one at a time.
ATOM_DEPTH = 16
ANGLE_DEPTH = 12
COMMENT_DEPTH = 8

WORD = r"[\p{L}\p{N}_]"
NAME = r"[\p{L}_$][\p{L}\p{N}_$]*+"

LINE_COMMENT = r"//[^\n]*+"
BLOCK_COMMENT = r"/\*(?s:.*?)\*/"
DOUBLE_QUOTED = r'"(?:[^"\\\n]++|\\(?s:.))*+"'
SINGLE_QUOTED = r"'(?:[^'\\\n]++|\\(?s:.))++'"
TRIPLE_DOUBLE = r'"""(?:[^"\\]++|\\(?s:.)|"(?!""))*+"""'
TRIPLE_SINGLE = r"'''(?:[^'\\]++|\\(?s:.)|'(?!''))*+'''"
PREPROCESSOR = r"#(?:[^\n\\/]++|\\(?s:.)|/\*(?s:.*?)\*/|/)*+"


def nested_comment(depth: int = COMMENT_DEPTH) -> str:
    """One Rust block comment with the block comments inside it."""
    inner = nested_comment(depth - 1) if depth else r"(?!)"
    return rf"/\*(?:[^*/]++|\*(?!/)|/(?!\*)|{inner})*+\*/"


NESTED_COMMENT = nested_comment()

LANGUAGES = ("python", "rust", "go", "java", "c", "cpp")
BRACE_LANGUAGES = ("rust", "go", "java", "c", "cpp")


def comments(lang: str) -> str:
    """Alternation matching one comment of ``lang``."""
    if lang == "python":
        return r"#[^\n]*+"
    return f"{NESTED_COMMENT if lang == 'rust' else BLOCK_COMMENT}|{LINE_COMMENT}"


def literals(lang: str, tag: str) -> str:
    """Alternation matching one string or character literal; ``tag`` keeps group names unique."""
    if lang == "python":
        single = r"'(?:[^'\\\n]++|\\(?s:.))*+'"
        return "|".join([TRIPLE_DOUBLE, TRIPLE_SINGLE, DOUBLE_QUOTED, single])
    if lang == "rust":
        raw = rf'\bb?c?r(?<r{tag}>#*+)"(?s:.*?)"\k<r{tag}>'
        text = r'"(?:[^"\\]++|\\(?s:.))*+"'
        char = r"'(?:[^'\\\n]|\\(?:u\{[0-9a-fA-F_]*+\}|x[0-9a-fA-F]{2}|[^ux]))'"
        return "|".join([raw, text, char, rf"'{WORD}++"])
    if lang == "go":
        return "|".join([r"`[^`]*+`", DOUBLE_QUOTED, SINGLE_QUOTED])
    if lang == "java":
        return "|".join([TRIPLE_DOUBLE, DOUBLE_QUOTED, SINGLE_QUOTED])
    if lang == "cpp":
        raw = rf'\b(?:u8|[uUL])?R"(?<r{tag}>[^()\\\s"]{{0,16}})\((?s:.*?)\)\k<r{tag}>"'
        return "|".join([raw, DOUBLE_QUOTED, SINGLE_QUOTED, r"\d\w*+(?:'\w++)++"])
    return "|".join([DOUBLE_QUOTED, SINGLE_QUOTED])


# Languages whose literals may start with a letter or digit need word-sized lexemes.
def _lexemes(lang: str, excluded: str, others: str) -> str:
    """Plain text without ``excluded``, or one of ``others``, all of which begin with an excluded character or as a word.

    Java tries alternatives in turn, so the runs that no other lexeme can begin come first.
    """
    if lang in ("rust", "cpp"):
        return rf"[^\p{{L}}\p{{N}}_{excluded}]++|{others}|{WORD}++"
    return rf"[^{excluded}]++|{others}"


def begins(lang: str) -> str:
    """Characters with which a comment or literal of ``lang`` begins, for a class; testing them first skips plain text."""
    return {"python": r"\"'#", "rust": r"\"'/bcr", "go": r"\"'/`", "cpp": r"\"'/uULR0-9"}.get(lang, r"\"'/")


def _specials(lang: str) -> str:
    """Characters that may begin a lexeme other than plain text, for a class."""
    return {"python": r"\"'#", "go": r"\"'/`", "java": r"\"'/@", "c": r"\"'/#", "cpp": r"\"'/#"}.get(lang, r"\"'/")


def bracket_atom(lang: str, tag: str = "a", depth: int = ATOM_DEPTH) -> str:
    """One balanced bracket group taken whole, literals and comments included."""
    inner = bracket_atom(lang, tag, depth - 1) if depth else r"(?!)"
    level = f"{tag}{depth}"
    parts = [comments(lang), literals(lang, level), inner]
    if lang == "java" and depth == ATOM_DEPTH:
        parts.append(annotation_atom(f"{tag}n"))
    if lang == "go" and depth >= ATOM_DEPTH - 1:  # a type with methods or fields, written out
        parts.append(rf"(?<=(?:interface|struct)\s{{0,4}}){any_brackets(lang, f'{level}t', chr(92) + '{', 4)}")
    if lang == "python":
        opening, closing = r"[(\[{]", r"[)\]}]"
    else:
        # A brace group without calls or statements: annotation arrays, empty types.
        filler = _lexemes(lang, "(){};" + _specials(lang), rf"{comments(lang)}|{literals(lang, level + 'f')}|[/@]")
        parts += [rf"\{{(?:{filler})*+\}}", r"[/@]"]
        if lang in ("c", "cpp"):
            parts.append(PREPROCESSOR)
        opening, closing = r"[(\[]", r"[)\]]"
    return rf"{opening}(?:{_lexemes(lang, r'()' + r'\[\]' + '{}' + _specials(lang), '|'.join(parts))})*+{closing}"


def any_brackets(lang: str, tag: str, opening: str = r"[(\[{]", depth: int = ATOM_DEPTH) -> str:
    """A balanced group of brackets of all kinds, for places that hold no statement."""
    inner = any_brackets(lang, tag, depth=depth - 1) if depth else r"(?!)"
    body = _lexemes(lang, r"()\[\]{}" + _specials(lang), rf"{comments(lang)}|{literals(lang, f'{tag}{depth}')}|[/@]|{inner}")
    return rf"{opening}(?:{body})*+[)\]}}]"


def annotation_atom(tag: str = "n") -> str:
    """A Java annotation with its arguments."""
    return rf"@(?!\s*+interface\b)\s*+[\w$]++(?:\s*+\.\s*+[\w$]++)*+\s*+{any_brackets('java', tag)}"


def piece_lexer(lang: str) -> str:
    """Pattern whose successive matches cut a file into statement-sized pieces.

    Brace languages end a piece at ``{``, ``}`` or ``;``; Go also where a newline
    ends a statement; C and C++ give each preprocessor line a piece of its own;
    Python makes one piece per logical line, with the blank, comment and
    decorator lines before it.
    """
    atom = bracket_atom(lang)
    if lang == "python":
        unit = _lexemes(lang, r"\n\\()\[\]{}" + _specials(lang), "|".join([comments(lang), literals(lang, "x"), atom, r"\\\n", r"[^\n]"]))
        blank = r"(?:[ \t\f\r]*+(?:#[^\n]*+)?\n)*+"
        decorators = rf"(?:[ \t]*+@(?:{unit})*+\n{blank})*+"
        return rf"(?=(?s:.)){blank}{decorators}(?:{unit})*+(?:\n|\z)"
    if lang == "go":
        ended = r"(?<=[\p{L}\p{N}_)\]}\"'`])"
        open_ = r"(?<![\p{L}\p{N}_)\]}\"'`])"
        notes = r"(?:/\*[^\n*]*+\*/[ \t\r]*+)?(?://[^\n]*+)?\n"
        line_end = rf"[ \t\r]*+{notes}"
        unit = "|".join([
            r"\b(?:interface|struct)\s*+\{\s*+\}", r"[^\s{};()\[\]\"'/`]++",
            rf"{open_}{line_end}", BLOCK_COMMENT, rf"{open_}{LINE_COMMENT}", literals(lang, "x"),
            atom, rf"[ \t\r]++(?!{notes})", r"[^\s{};/]", r"/(?![/*])", r"/(?=\*)",
        ])
        return rf"(?:{unit})++(?:[{{}};]|{ended}{line_end}|\z)|[{{}};]|{ended}{line_end}|(?s:.)"
    unit = [comments(lang), literals(lang, "x"), atom]
    if lang == "java":
        unit.insert(2, annotation_atom())
    if lang == "cpp":
        # Brace initialisers glued to a name: ``total{0}`` or ``: a{}, b{} {``.
        filler = _lexemes(lang, r"()\[\]{};" + _specials(lang), rf"{comments(lang)}|{literals(lang, 'i')}|{bracket_atom(lang, 'j', 2)}|/")
        unit += [rf"(?<=\w)\{{(?!\s*+\}})(?:{filler})*+\}}", r"(?<=\w)\{\s*+\}(?=\s*+[,{])"]
    other = r"[^{};#]" if lang in ("c", "cpp") else r"[^{};]"
    body = f"{_lexemes(lang, r'{};()' + r'\[\]' + _specials(lang), '|'.join(unit))}|{other}"
    if lang in ("c", "cpp"):
        return rf"(?:{body})++(?:[{{}};]|(?=#)|\z)|[{{}};]|{PREPROCESSOR}"
    return rf"(?:{body})++(?:[{{}};]|\z)|[{{}};]"


def bracket_residue(lang: str) -> str:
    """What to delete from a piece so that brackets and stray delimiters remain."""
    kept = {"python": r"()\[\]{}\"'#", "go": r"()\[\]{};\"'/`"}.get(lang, r"()\[\]{};\"'/")
    # Plain runs first: no comment or literal begins like them.
    parts = [rf"\A{PREPROCESSOR}"] if lang in ("c", "cpp") else []
    if lang in ("rust", "cpp"):
        parts += [rf"[^\p{{L}}\p{{N}}_{kept}]++", comments(lang), literals(lang, "q"), rf"{WORD}++"]
    elif lang == "go":
        parts += [rf"[^\p{{L}}\p{{N}}_{kept}]++", rf"\b(?:interface|struct)\s*+\{{\s*+\}}", rf"{WORD}++", comments(lang), literals(lang, "q")]
    else:
        parts += [rf"[^{kept}]++", comments(lang), literals(lang, "q")]
    if lang != "python":
        parts.append(r"/(?!\*)")
    return "|".join(parts)


def balanced(pairs: str, depth: int) -> str:
    """Alternation of balanced bracket words over ``pairs`` such as ``()[]``."""
    inner = balanced(pairs, depth - 1) if depth else ""
    body = f"(?:{inner})*+" if inner else ""
    return "|".join(rf"\{pairs[i]}{body}\{pairs[i + 1]}" for i in range(0, len(pairs), 2))


def nested(opening: str, closing: str, filler: str, depth: int) -> str:
    """Balanced ``opening … closing`` group around ``filler`` alternatives."""
    inner = nested(opening, closing, filler, depth - 1) if depth else r"(?!)"
    return rf"{opening}(?:{filler}|{inner})*+{closing}"


# Patterns over a *skeleton*: comment-free, literal-free, blank-collapsed text.
PARENS = nested(r"\(", r"\)", r"[^()]++", ATOM_DEPTH)
ANGLES = nested("<", ">", rf"->|[^<>()\-]++|-|{PARENS}", ANGLE_DEPTH)


def lead(lang: str) -> str:
    """Everything in a piece before the first token of its statement."""
    if lang == "python":
        unit = _lexemes(lang, r"\n\\()\[\]{}" + _specials(lang), "|".join([comments(lang), literals(lang, "x"), bracket_atom(lang), r"\\\n", r"[^\n]"]))
        blank = r"(?:[ \t\f\r]*+(?:#[^\n]*+)?\n)*+"
        return rf"\A{blank}(?:[ \t]*+@(?:{unit})*+\n{blank})*+[ \t\f]*+"
    parts = [r"\s++", comments(lang)]
    if lang == "rust":
        parts.append(rf"#!?\s*+{bracket_atom(lang)}")
    if lang in ("c", "cpp"):
        parts.append(r'extern\s++"[^"\n]*+"(?=\s*+[^\s{])')
    if lang == "cpp":
        parts += [r"(?:public|private|protected|signals|slots)\b[^:;{}()]{0,32}:(?!:)", rf"template\s*+{ANGLES}"]
    return rf"\A(?:{'|'.join(parts)})*+"


def last_comment(lang: str) -> tuple[str, int]:
    """Pattern and group number of the comment that ends a lead, if only blanks follow it."""
    parts = [r"\s++", comments(lang)]
    if lang == "rust":
        parts.append(rf"#!?\s*+{bracket_atom(lang)}")
    if lang == "cpp":
        parts += [r"\w++[^:;{}()/]{0,32}:(?!:)", rf"template\s*+{ANGLES}"]
    if lang in ("c", "cpp"):
        parts.append(r'extern\s++"[^"\n]*+"')
    head = rf"\A(?:(?:{'|'.join(parts)})(?!\s*+\z))*+"
    return rf"{head}({comments(lang)})\s*+\z", 1 + len(re.findall(r"\(\?<[a-zA-Z]", head))


def strip_comments(lang: str) -> str:
    """Replace with ``$1$1$2$2 ``: comments vanish, plain literals keep only their quotes."""
    if lang == "python":
        single = r"(')(?:[^'\\\n]++|\\(?s:.))*+'"
        double = r'(")(?:[^"\\\n]++|\\(?s:.))*+"'
        return rf"(?=[{begins(lang)}\\])(?:(?:{TRIPLE_DOUBLE}|{TRIPLE_SINGLE})|{double}|{single}|#[^\n]*+|\\\n)"
    char = r"(')(?:[^'\\\n]|\\[^\n]{1,10}?)'"
    double = r'(")(?:[^"\\]++|\\(?s:.))*+"'
    raw = {"rust": literals("rust", "w").split("|", 1)[0], "go": r"`[^`]*+`", "java": TRIPLE_DOUBLE,
           "cpp": literals("cpp", "w").split('|"', 1)[0]}.get(lang)
    parts = [comments(lang), char]
    # Raw forms come before the plain quote they start like.
    found = "|".join(([raw] if lang in ("java", "go") else []) + [double] + parts + ([raw] if lang in ("rust", "cpp") else []))
    return rf"(?=[{begins(lang)}])(?:{found})"
