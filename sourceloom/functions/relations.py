"""Column functions that read relations out of code: imports, calls, comments, types, bases."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sourceloom.functions import headers as H
from sourceloom.functions import patterns as P
from sourceloom.functions.patterns import ANGLES, NAME, PARENS
from sourceloom.functions.text import strip_quotes

# Words that look like calls, per all languages together, and words
# that qualify a type without naming one.
NOT_CALLS = ("if", "for", "while", "switch", "catch", "return", "sizeof", "match", "elif", "else", "and", "or", "not",
             "in", "is", "lambda", "assert", "yield", "await", "del", "with", "except", "func", "fn",
             "def", "class", "synchronized", "throw", "new", "case", "do", "try", "super", "this", "alignof",
             "decltype", "typeof", "int", "char", "void", "long", "short", "float", "double", "bool", "unsigned", "defined", "select", "go", "defer", "range", "loop", "move", "where", "impl")
NOT_TYPES = ("const", "volatile", "static", "inline", "extern", "virtual", "final", "public", "private", "protected",
             "abstract", "synchronized", "native", "struct", "union", "enum", "class", "typename", "mut", "dyn", "ref",
             "impl", "where", "unsafe", "register", "restrict", "constexpr", "explicit", "friend", "chan", "map",
             "func", "interface", "fn", "for", "extends", "throws", "self", "Self", "std", "default", "strictfp")

_NONE = "array<string>"


def _empty() -> Column:
    return F.array().cast(_NONE)


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _except(words: tuple[str, ...]) -> str:
    """Lookahead that refuses the whole words."""
    return rf"(?!(?:{'|'.join(words)})(?![\p{{L}}\p{{N}}_$]))"


def _bare(text: Column, lang: str) -> Column:
    """Text without comments; literals keep their quotes only."""
    return F.regexp_replace(text, P.strip_comments(lang), "$1$1$2$2 ")


def comments(code: Column, lang: str) -> Column:
    """Comments inside a chunk, in order; text inside literals is skipped."""
    pattern = rf"(?=[{P.begins(lang)}])(?:({P.comments(lang)})|{P.literals(lang, 'z')})"
    return F.filter(_all(code, pattern, 1), lambda c: c != "")


def imports(text: Column, lang: str) -> Column:
    """Imported modules or included headers of a file, in order, without repeats."""
    blank = r"[ \t]*+"
    if lang == "python":
        body = F.regexp_replace(text, rf"{P.TRIPLE_DOUBLE}|{P.TRIPLE_SINGLE}", "")
        plain = _all(body, rf"(?m)^{blank}(?:from[ \t]++([.\w]++)[ \t]++import\b|import[ \t]++([^\n#;]++))", 0)
        words = F.flatten(F.transform(plain, lambda line: F.when(
            F.trim(line).startswith("from"), F.array(F.regexp_extract(line, r"from[ \t]++([.\w]++)", 1))
        ).otherwise(F.transform(
            F.split(F.regexp_replace(line, r"\A\s*import\s+", ""), ","),
            lambda part: F.regexp_extract(part, r"\A\s*([.\w]++)", 1)))))
        return F.array_distinct(F.filter(words, lambda w: w != ""))
    if lang in ("c", "cpp"):
        return F.array_distinct(_all(
            F.regexp_replace(text, P.BLOCK_COMMENT, " "), rf"(?m)^{blank}#{blank}include{blank}[<\"]([^>\"\n]++)[>\"]", 1))
    if lang == "go":
        body = F.regexp_replace(text, P.comments(lang), " ")
        blocks = _all(body, r"(?m)^import\s*+(?:\(([^()]*+)\)|((?:[\w.]++[ \t]++)?\"[^\"\n]*+\"))", 0)
        return F.array_distinct(F.flatten(F.transform(blocks, lambda b: _all(b, r"\"([^\"\n]*+)\"", 1))))
    bare = _bare(text, lang)
    if lang == "java":
        return F.array_distinct(_all(bare, rf"(?m)^{blank}import\s++(?:static\s++)?([\w.]++(?:\.\*)?)\s*+;", 1))
    used = _all(bare, rf"(?m)^{blank}(?:pub(?:\([^)]*\))?\s++)?use\s++([^;]++);", 1)
    return F.array_distinct(F.transform(used, lambda u: F.regexp_replace(u, r"\s++", " ")))


def calls(code: Column, lang: str) -> Column:
    """Distinct names followed by ``(``, minus keywords and declared names."""
    bare = _bare(code, lang)
    declared = {"python": r"(?:def|class)\s++", "rust": r"(?:fn|struct|enum)\s++", "go": r"func\s++(?:\([^()]*\)\s*+)?"}
    if lang in declared:
        bare = F.regexp_replace(bare, rf"\b{declared[lang]}{NAME}(?:\s*+{ANGLES}|\s*+\[[^\[\]]*+\])?(?:\s*+\()?", " ")
        bare = F.regexp_replace(bare, r"\bpub\s*+\([^()]*+\)", " ") if lang == "rust" else bare
    else:
        # Drop the declared name of the chunk and of the functions defined inside it.
        bare = F.regexp_replace(bare, rf"\A([^(){{}};=]*?)(?<![\p{{L}}\p{{N}}_$]){NAME}\s*+\(", "$1 ")
        bare = F.regexp_replace(bare, rf"(?<=[\w>\]*&] )(?<!\bnew ){NAME}(?=\s*+{PARENS}\s*+(?:const\s*+|throws\s[\w.,\s]++)?\{{)", " ")
    # Most words are no calls: only those before ``(`` or ``::`` are compared with the list.
    return F.array_distinct(_all(
        bare, rf"(?<![\p{{L}}\p{{N}}_$@])(?={NAME}\s*+[(:]){_except(NOT_CALLS)}({NAME})\s*+(?:::\s*+{ANGLES}\s*+)?\(", 1))


def attributes(lead: Column, skeleton: Column, lang: str) -> Column:
    """Decorators, annotations or attributes of a declaration, as written."""
    if lang == "python":
        return F.transform(_all(lead, r"(?m)^[ \t]*+(@[^\n]*+)", 1), lambda a: F.trim(a))
    if lang == "rust":
        return _all(_bare(lead, lang), rf"(#!?\s*+{P.nested(r'\[', r'\]', r'[^\[\]]++', 4)})", 1)
    if lang == "java":
        return F.transform(_all(skeleton, rf"(@(?! ?interface\b) ?[\w.$]++(?: ?{PARENS})?)", 1), lambda a: F.trim(a))
    if lang == "go":
        return _empty()
    return _all(skeleton, r"(\[\[[^\]]*+\]\])", 1)


def types_used(entries: Column, names: Column, result: Column, lang: str) -> Column:
    """Distinct type names in the parameter entries and the result type of a header."""
    if lang in ("python", "rust"):
        typed = F.transform(entries, lambda e: F.regexp_extract(e, r"\A[^:=]*+:(?!:)([^=]*+)", 1))
    elif lang == "go":
        typed = F.transform(entries, lambda e: F.regexp_extract(e, rf"\A{NAME} (.*)\z", 1))
    elif lang == "java":
        typed = F.transform(entries, lambda e: F.regexp_replace(H.plain(e, "java"), rf"{NAME}(?: ?\[ ?\])*+\z", ""))
    else:
        pointed, last = rf"\( ?[*&^][*& ]*{NAME}", rf" ?=.*\z|{NAME}(?: ?\[[^\]]*+\])*+(?=(?: ?=.*)?\z)"
        typed = F.zip_with(entries, names, lambda e, n: F.when(n == "", e).when(
            e.rlike(pointed), F.regexp_replace(e, pointed, "(")).otherwise(F.regexp_replace(e, last, "")))
    text = F.concat_ws(" ", typed, result)
    return F.array_distinct(_all(text, rf"(?<![\p{{L}}\p{{N}}_$]){_except(NOT_TYPES)}({NAME})", 1))


def bases(clean: Column, lang: str) -> Column:
    """Base classes, interfaces or traits named by a class-like header."""
    if lang == "python":
        inner = F.regexp_extract(clean, rf"\Aclass {NAME} ?(?:\[[^\]]*\] ?)?({PARENS})", 1)
        return F.filter(H.split_parameters(inner, lang), lambda b: ~b.contains("=") & ~b.startswith("*"))
    if lang == "rust":
        trait = F.regexp_extract(clean, rf"\A(?:unsafe )?impl ?(?:{ANGLES} ?)?!?(.+?) for ", 1)
        return F.filter(F.array(F.trim(trait)), lambda b: b != "")
    if lang == "java":
        listed = F.regexp_extract(clean, r"\b(?:extends|implements) (.*)\z", 1)
        listed = F.regexp_replace(F.regexp_replace(listed, r" ?\bpermits .*\z", ""), r" ?\b(?:extends|implements)\b ?", ",")
        return H.split_parameters(F.concat(F.lit("("), listed, F.lit(")")), lang)
    if lang == "cpp":
        listed = F.regexp_extract(clean, r"(?<!:):(?!:)(.*)\z", 1)
        parts = H.split_parameters(F.concat(F.lit("("), listed, F.lit(")")), lang)
        return F.transform(parts, lambda b: F.trim(F.regexp_replace(b, r"\b(?:public|private|protected|virtual)\b", "")))
    return _empty()


# Words that begin a Python statement which is not an expression.
_NOT_EXPRESSIONS = (r"(?:pass|return|if|elif|else|for|while|try|except|finally|with|def|class|import|from|raise|assert|"
                    r"del|global|nonlocal|break|continue|async|match|case|type)\b")


def python_docstring(code: Column) -> Column:
    """First expression statement of the body, if it is one plain string."""
    prefix = r"(?:[rRbBuUfF]{0,2})"
    single = r"'(?:[^'\\\n]++|\\(?s:.))*+'"
    string = rf"{prefix}(?:{P.TRIPLE_DOUBLE}|{P.TRIPLE_SINGLE}|{P.DOUBLE_QUOTED}|{single})"
    atom = P.bracket_atom("python")
    header = rf"\A(?:async\s++)?def\s++{NAME}\s*+(?:{atom}\s*+){{1,2}}(?:->(?:{atom}|{P.DOUBLE_QUOTED}|{single}|[^:\[\]()\"'])++)?:"
    lexeme = rf"#[^\n]*+|{P.literals('python', 'z')}|{atom}|[^\n\"'#()\[\]{{}}]++|[^\n]"
    gap = r"[ \t\f]*+(?:#[^\n]*+)?(?:\n[ \t\f]*+(?:#[^\n]*+)?(?=\n))*+"
    # Group 1 is the newline and indentation of the body; a statement is skipped up to the next such line.
    end = r"(?=[ \t]*+(?:[;#\n]|\z))"
    one_line = rf"{header}[ \t]*+({string}){end}"
    block = rf"{header}{gap}\n([ \t]++)(?:{_NOT_EXPRESSIONS}(?:{lexeme}|\n(?!\1[^\s#]))*+\n\1)*+({string}){end}"
    first = F.regexp_extract(code, one_line, 1)
    found = F.when(first != "", first).otherwise(F.regexp_extract(code, block, 2))
    return F.when(found != "", strip_quotes(found))
