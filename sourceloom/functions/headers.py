"""Column functions on a statement *skeleton* (no comments, empty literals, single blanks).

``kind`` decides what a block is; the others project the attributes of a
function header.  One pattern per language replaces the grammar rule.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from sourceloom.functions import patterns as P
from sourceloom.functions.patterns import ANGLES, NAME, PARENS
from sourceloom.functions.text import bound

# Words that look like a call header but open a control block, and
# words that cannot precede a declared name.
CONTROL_WORDS = {
    "java": ("if", "for", "while", "switch", "catch", "synchronized", "try", "return", "else", "do", "new", "throw",
             "assert", "yield", "super", "this", "case"),
    "c": ("if", "for", "while", "switch", "return", "else", "do", "sizeof", "case", "defined"),
    "cpp": ("if", "for", "while", "switch", "catch", "try", "return", "else", "do", "new", "delete", "throw", "sizeof",
            "case", "defined", "this", "decltype"),
}
STATEMENT_WORDS = {
    "java": r"(?:new|return|throw|else|case|assert|yield|do|instanceof|package|import)",
    "c": r"(?:return|else|case|do|goto|sizeof)",
    "cpp": r"(?:new|return|throw|else|case|do|goto|using|delete|co_await|co_yield|co_return)",
}
# Modifier words that are reported.
RUST_MODIFIERS = ("async", "unsafe", "const", "extern")
JAVA_MODIFIERS = ("public", "private", "protected", "static", "final", "abstract", "synchronized", "native")
C_MODIFIERS = ("static", "extern", "inline")
CPP_MODIFIERS = ("static", "extern", "inline", "virtual")

_SQUARE = P.nested(r"\[", r"\]", r"[^\[\]]++", P.ATOM_DEPTH)
_CURLY = P.nested(r"\{", r"\}", r"[^{}]++", P.ATOM_DEPTH)
_ANNOTATION = rf"@(?! ?interface\b) ?[\w.$]++(?: ?{PARENS})?"
_C_NOISE = rf"\[\[[^\]]*+\]\]|\b(?:__attribute__|__declspec|alignas|__asm__|explicit) ?{PARENS}"
_JAVA_TYPE = r"[\p{L}\p{N}_.$?,&<>\[\] ]*?"
_BOUNDARY = r"(?<![\p{L}\p{N}_$~])"
_CPP_NAME = rf"~ ?{NAME}|operator ?(?:\( ?\)|\"\" ?\w++|[^\s\w(]++|\w[\w :<>*&\[\]]*+)|{NAME}"
_CPP_TAIL = rf"(?: ?(?:const\b|volatile\b|noexcept\b(?: ?{PARENS})?|override\b|final\b|throw ?{PARENS}|try\b|&&?|-> ?[^:()={{}}]++(?:::[^:()={{}}]++)*+|requires [^:={{}}]++))*+"

# Groups of every pattern: 1 what stands before the name, 2 the name, 3 the parameters.
FUNCTION = {
    "python": rf"\A((?:async )?)def ({NAME}) ?(?:{_SQUARE} ?)?({PARENS})",
    "rust": rf"\A((?:pub(?: ?\([^()]*+\))? )?(?:(?:default|const|async|unsafe|safe|extern(?: ?\"\")?) )*+)fn ((?:r#)?(?!\$){NAME}) ?(?:{ANGLES} ?)?({PARENS})",
    "go": rf"\Afunc ?((?:{PARENS} ?)?)({NAME}) ?(?:{_SQUARE} ?)?({PARENS})",
    "java": rf"\A({_JAVA_TYPE}){_BOUNDARY}({NAME}) ?({PARENS})(?: ?\[ ?\])*+(?: throws [^=()]++)?\z",
    "c": rf"\A((?!.*\btypedef\b)[^=()]*?[\s*]){_BOUNDARY}({NAME}) ?({PARENS})\z",
    "cpp": rf"\A([^=()]*?){_BOUNDARY}({_CPP_NAME}) ?({PARENS}){_CPP_TAIL} ?(?::(?!:).*)?\z",
}
# C functions that return a function pointer have no plain name.
_C_NAMELESS = rf"\A([^=()]*)()\( ?\*.*?\) ?({PARENS})\z"
_JAVA_TYPE_HEADER = rf"\A(?:(?:public|protected|private|static|final|abstract|strictfp|sealed|non-sealed) )*+(class|interface|enum|record|@ ?interface) ({NAME})"
_JAVA_ANONYMOUS = rf"\bnew [^;={{}}]*?{PARENS}\z"
_CPP_CLASS_HEADER = rf"\A(?:(?:typedef|static|const|inline|friend|constexpr) )*+(?:class|struct)\b(?: {NAME})*? ?((?:{NAME}(?: ?::)?)*(?: ?{ANGLES})?)(?: final)?(?: ?:(?!:).*)?\z"


def by_language(language: Column, build: Callable[[str], Column], langs=P.LANGUAGES) -> Column:
    """CASE over the language with one literal pattern per branch; rows hold only ``langs``."""
    if len(langs) == 1:
        return build(langs[0])
    result = F.when(language == langs[0], build(langs[0]))
    for lang in langs[1:]:
        result = result.when(language == lang, build(lang))
    return result


# Noise is rare, so its removal hides behind a plain substring test.
_NOISE = {"java": (_ANNOTATION, ("@",)), "c": (_C_NOISE, ("__", "[[", "alignas")),
          "cpp": (_C_NOISE, ("__", "[[", "alignas", "explicit"))}


def plain(skeleton: Column, lang: str) -> Column:
    """Skeleton without annotations (Java) or attribute noise (C, C++)."""
    if lang not in _NOISE:
        return skeleton
    noise, signs = _NOISE[lang]
    present = skeleton.contains(signs[0])
    for sign in signs[1:]:
        present |= skeleton.contains(sign)
    return F.when(present, F.trim(F.regexp_replace(F.regexp_replace(skeleton, noise, " "), "  ++", " "))).otherwise(skeleton)


def opens_candidate(piece: Column, core: Column, lang: str) -> Column:
    """Cheap test that rules out most control blocks before any header is parsed."""
    if lang == "rust":
        return piece.contains("fn") | piece.contains("impl")
    if lang == "go":
        return core.startswith("func")
    control = "if|else|for|while|do|switch" + ("" if lang == "c" else "|try|catch|finally")
    return ~core.rlike(rf"\A(?:{control})\b")


def _usable(prefix: Column, name: Column, lang: str) -> Column:
    if lang not in CONTROL_WORDS:
        return name != ""
    misplaced = prefix.rlike(rf"(?:\A|[^\w]){STATEMENT_WORDS[lang]}(?:[^\w]|\z)")
    return name.rlike(rf"\A(?!(?:{'|'.join(CONTROL_WORDS[lang])})\z).") & ~misplaced


def kind(clean: Column, lang: str, terminator: Column) -> Column:
    """``f`` function, ``c`` class-like that gives scope, ``k`` other holder, NULL anything else."""
    part = lambda pattern, group: F.regexp_extract(clean, pattern, group)
    function = _usable(part(FUNCTION[lang], 1), part(FUNCTION[lang], 2), lang)
    if lang == "python":
        return F.when(clean.rlike(rf"\A(?:async )?def {NAME}"), "f").when(clean.rlike(rf"\Aclass {NAME}"), "c")
    if lang == "rust":
        return F.when(function, "f").when(clean.rlike(r"\A(?:unsafe )?impl\b"), "c")
    if lang == "go":
        return F.when(function, "f")
    if lang == "java":
        header = part(_JAVA_TYPE_HEADER, 1)
        opened = (
            F.when(header == "class", "c").when(header != "", "k")
            .when(clean.rlike(_JAVA_ANONYMOUS), "k").when(function, "f")
        )
        declared = F.when(function & java_parameters_only(part(FUNCTION["java"], 3))
                          & part(FUNCTION["java"], 1).rlike(r"\S"), "f")
        return F.when(terminator == "{", opened).otherwise(declared)
    if lang == "c":
        return F.when(clean.rlike(r'\Aextern ?""'), "k").when(function | clean.rlike(_C_NAMELESS), "f")
    opened = (
        F.when(clean.rlike(r'\A(?:(?:inline )?namespace\b[^()=]*\z|extern ?""|union\b[^()=]*\z)'), "k")
        .when(clean.rlike(_CPP_CLASS_HEADER), "c").when(function, "f")
    )
    return F.when(terminator == "{", opened).otherwise(F.when(function, "f"))


def java_parameters_only(params: Column) -> Column:
    """Every entry reads ``type name`` (or there is none)."""
    entries = split_parameters(params, "java")
    return F.forall(entries, lambda e: plain(e, "java").rlike(rf"\A[^=()]*[\w>\]] ?(?:\.\.\.)? {NAME}(?: ?\[ ?\])*+\z"))


def holder_name(clean: Column, lang: str) -> Column:
    """Name of a class-like block; empty if it has none."""
    if lang == "python":
        return F.regexp_extract(clean, rf"\Aclass ({NAME})", 1)
    if lang == "rust":
        target = rf"\A(?:unsafe )?impl ?(?:{ANGLES} ?)?(?:.*? for )?[&*]*((?:{NAME}::)*{NAME})"
        return F.regexp_extract(clean, target, 1)
    if lang == "java":
        return F.regexp_extract(clean, _JAVA_TYPE_HEADER, 2)
    if lang == "cpp":
        return F.trim(F.regexp_extract(clean, _CPP_CLASS_HEADER, 1))
    return F.lit("")


def holder_word(clean: Column, lang: str) -> Column:
    """Java keyword of a class-like header, without blanks."""
    if lang != "java":
        return F.lit("")
    return F.translate(F.regexp_extract(clean, _JAVA_TYPE_HEADER, 1), " ", "")


def name(clean: Column, lang: str) -> Column:
    found = F.regexp_extract(clean, FUNCTION[lang], 2)
    if lang == "python":
        found = F.regexp_extract(clean, rf"\A(?:async )?def ({NAME})", 1)
    if lang == "cpp":
        prefix = F.regexp_extract(clean, FUNCTION[lang], 1)
        deep = prefix.rlike(rf"{NAME}(?: ?{ANGLES})? ?:: ?{NAME}(?: ?{ANGLES})? ?:: ?\z")
        found = F.when(deep | ~found.rlike(rf"\A{NAME}\z") | found.rlike(r"\Aoperator\b"), F.lit("")).otherwise(found)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("unknown"))


def parameters(clean: Column, lang: str) -> Column:
    """Text of the parameter list, parentheses included."""
    found = F.regexp_extract(clean, FUNCTION[lang], 3)
    if lang == "c":
        return F.when(found != "", found).otherwise(F.regexp_extract(clean, _C_NAMELESS, 3))
    return found


def split_parameters(params: Column, lang: str) -> Column:
    """Entries between the commas of the outermost level, trimmed."""
    inner = F.substring(params, F.lit(2), F.greatest(F.length(params) - 2, F.lit(0)))
    groups = [PARENS, _SQUARE, _CURLY]
    if lang in ("java", "rust", "cpp"):
        groups.append(ANGLES)
    pattern = rf"(?:[^,()\[\]{{}}<]++|{'|'.join(groups)}|[()\[\]{{}}<])++"
    entries = F.transform(F.regexp_extract_all(inner, F.lit(pattern), F.lit(0)), lambda e: F.trim(e))
    return F.filter(entries, lambda e: e != "")


_C_WORDS = r"(?:unsigned|signed|long|short|int|char|float|double|void|bool|_Bool|auto|wchar_t|char8_t|char16_t|char32_t)"
_C_SKIPPED = rf" ?=.*\z|{_C_NOISE}|\b(?:const|volatile|restrict|__restrict|register|static)\b|{ANGLES}"
_C_TYPE = rf"\b(?:struct|union|enum|class|typename) (?:{NAME}::)*{NAME}|\b{_C_WORDS}(?: ++{_C_WORDS})*+\b"
_C_POINTED = rf"\( ?(?:{NAME}::)?[*&^][*& ]*({NAME})"
_C_NAMED = rf"\A ?(?:::)?{NAME}(?: ?:: ?{NAME})*+(?: ?[*&]++ ?| )++({NAME})(?: ?{_SQUARE})*+ ?\z"


def _c_declared(entry: Column) -> Column:
    """Declared identifier of a C or C++ parameter; empty for types alone."""
    typed = F.regexp_replace(F.regexp_replace(entry, _C_SKIPPED, " "), _C_TYPE, "T ")
    return bound(F.regexp_replace(typed, "  ++", " "), lambda t: F.when(
        t.rlike(_C_POINTED), F.regexp_extract(t, _C_POINTED, 1)).otherwise(F.regexp_extract(t, _C_NAMED, 1)))


def entry_names(entries: Column, lang: str) -> Column:
    """The reported name of every parameter entry, empty for those not reported."""
    if lang == "python":
        # An annotated entry with a default is not reported, nor are starred ones.
        pattern = rf"\A({NAME})(?: ?=.*| ?:[^=]*+)?\z"
        return F.transform(entries, lambda e: F.regexp_extract(e, pattern, 1))
    if lang == "rust":
        pattern = rf"\A(?:#{_SQUARE} ?)*+(?:mut )?((?:[^:]|::)++):(?!:)"
        return F.transform(entries, lambda e: F.trim(F.regexp_extract(e, pattern, 1)))
    if lang == "go":
        named = rf"\A(?!(?:chan|func|map|struct|interface)\b){NAME} \S"
        pattern = rf"\A({NAME})(?: (?!\.\.\.)\S.*)?\z"
        return F.when(
            F.exists(entries, lambda e: e.rlike(named)), F.transform(entries, lambda e: F.regexp_extract(e, pattern, 1))
        ).otherwise(F.array().cast("array<string>"))
    if lang == "java":
        pattern = rf"\A(?!.*\.\.\.).*[>\]\p{{L}}\p{{N}}_] ?{_BOUNDARY}({NAME})(?: ?\[ ?\])*+\z"
        return F.transform(entries, lambda e: F.regexp_extract(e, pattern, 1))
    return F.transform(entries, _c_declared)


def arguments(names: Column, clean: Column, lang: str) -> Column:
    """Argument names as the reference reports them, in order."""
    left_out = {"python": r"self", "rust": r"(?:&(?:mut )?)?self", "java": "this"}.get(lang)
    kept = F.filter(names, lambda n: n != "" if left_out is None else ~n.rlike(rf"\A(?:{left_out})?\z"))
    if lang != "c":
        return kept
    # Parameters behind more than one level of pointer result are not seen.
    stars = F.regexp_extract(clean, FUNCTION["c"], 1).rlike(r"\*[^*]*\* ?(?:const ?)?\z")
    return F.when(stars, F.array().cast("array<string>")).otherwise(kept)


def _words(text: Column, allowed: tuple[str, ...]) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?<![\w$])({'|'.join(allowed)})(?![\w$])"), F.lit(1))


def modifiers(clean: Column, lang: str) -> Column:
    """Modifier words before the name, in source order."""
    allowed = {"rust": RUST_MODIFIERS, "java": JAVA_MODIFIERS, "c": C_MODIFIERS, "cpp": CPP_MODIFIERS}.get(lang)
    if allowed is None:
        return F.array().cast("array<string>")
    prefix = F.regexp_extract(clean, FUNCTION[lang] if lang in ("rust", "java") else r"\A([^(]*)", 1)
    if lang == "rust":
        # A quoted ABI belongs to its word, so only a bare one is a modifier.
        prefix = F.regexp_replace(prefix, r'extern ?""', " ")
        visible = F.when(prefix.rlike(r"\Apub\b"), F.array(F.lit("pub"))).otherwise(F.array().cast("array<string>"))
        return F.concat(visible, _words(prefix, allowed))
    return _words(prefix, allowed)


def return_type(clean: Column, lang: str) -> Column:
    """Declared result type; NULL where the header declares none."""
    if lang == "python":
        found = F.regexp_extract(clean, rf"{FUNCTION['python']} ?-> ?((?:{_SQUARE}|[^:\[\]])++) ?:", 4)
    elif lang == "rust":
        found = F.regexp_extract(clean, rf"{FUNCTION['rust']} ?-> ?(.+?)(?: where .*)?\z", 4)
    elif lang == "go":
        found = F.regexp_extract(clean, rf"{FUNCTION['go']} ?(.+)\z", 4)
    else:
        words = {"java": JAVA_MODIFIERS + ("default", "strictfp"), "c": C_MODIFIERS,
                 "cpp": CPP_MODIFIERS + ("constexpr", "consteval", "explicit", "friend")}[lang]
        prefix = F.regexp_extract(clean, FUNCTION[lang], 1)
        prefix = F.regexp_replace(prefix, rf"\b(?:{'|'.join(words)})\b ?", "")
        if lang == "java":
            prefix = F.regexp_replace(F.trim(prefix), rf"\A{ANGLES} ?", "")
        if lang == "cpp":
            trailing = F.regexp_extract(clean, rf"{FUNCTION['cpp'].split(_CPP_TAIL)[0]}[^:={{}}]*?-> ?((?:[^:{{}}]|::)++)", 4)
            owner = F.regexp_replace(prefix, rf"(?:{NAME}(?: ?{ANGLES})? ?:: ?)++\z", "")
            prefix = F.when(trailing != "", trailing).otherwise(owner)
        found = prefix
    return F.nullif(F.trim(found), F.lit(""))
