"""A source corpus rendered from the ``part`` table, and what extraction must find in it.

One SQL expression per language turns a part into a source file; it reads the
same in Spark and in DuckDB.  Beside each template stand the facts of its
functions, written down by hand, from which the oracle SQL is assembled.  The
oracle therefore never repeats the extraction.

Placeholders: ``«k»`` part key, ``«w»`` first word of the name, ``«s»`` size and
``«b»`` a body line repeated ``size % 4`` times.  In facts, ``b`` is that count
and ``K`` the number of digits of the key.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

KEY = "cast(p_partkey as string)"
WORD = "split_part(p_name, ' ', 1)"
BODY_COUNT = "(p_size % 4)"
VARIANT = "((p_partkey - p_partkey % 6) / 6) % 6"  # 1 CRLF, 2 upper-case suffix, 3 broken, 4 ignored, 5 taken back
IGNORE_RULES = ("# built files", "", "build/", "*.tmp", "!build/keep/")
LANGUAGES = ("python", "rust", "go", "java", "c", "cpp")
SUFFIX = {"python": "py", "rust": "rs", "go": "go", "java": "java", "c": "c", "cpp": "cpp"}


@dataclass(frozen=True)
class Fact:
    """Expected attributes of one function; texts may hold placeholders, numbers are SQL."""

    name: str
    start: str
    end: str
    start_column: str
    end_column: str
    arguments: str = ""
    docstring: str | None = None
    scope: str = "global"
    function_type: str = "function"
    modifiers: str = ""
    loc: str = "1"
    complexity: str = "1"
    comment_lines: str = "0"
    return_type: str | None = None
    calls: str = ""
    comments: str = ""
    attributes: str = ""
    types_used: str = ""


TEMPLATES: dict[str, str] = {}
BODY_LINE: dict[str, str] = {}
FACTS: dict[str, list[Fact]] = {}
IMPORTS: dict[str, str] = {}
EDGES: dict[str, list[tuple[str, str]]] = {}

BODY_LINE["python"] = "        total += 1\n"
TEMPLATES["python"] = '''"""Module «k»."""
import os
from demo.«w» import helper as h, other


class Part«k»(Base, metaclass=Meta):
    """Class doc."""

    @property
    @cached(size=«s»)
    def size_«k»(self, factor, scale=1.5, unit: str = "}", *args, **kw) -> int:
        """Size of the part.

low indented text def fake():
        """
        total = [
            factor,
    self,
        ]
«b»        def inner(cls, x: "int"):
            return x if x else total  # trailing
        # last note of the method

    async def load(self, *, path: str):
        pass
        'loaded'


# module note
def free_«k»(a, b=(1, 2)): return a + b[0]


if True:
    def tail():
        return free_«k»(1)
'''
FACTS["python"] = [
    Fact("size_«k»", "11", "22+b", "4", "33", "factor,scale", "Size of the part.\n\nlow indented text def fake():", "class",
         "method", loc="10+b", complexity="3", comment_lines="1", return_type="int",
         comments="# trailing|# last note of the method", attributes="@property|@cached(size=«s»)", types_used="str,int"),
    Fact("inner", "20+b", "21+b", "8", "48", "cls,x", None, "class", "method", loc="2", complexity="3", comments="# trailing"),
    Fact("load", "24+b", "26+b", "4", "16", "path", "loaded", "class", "method", loc="3", types_used="str"),
    Fact("free_«k»", "30+b", "30+b", "0", "39+K", "a,b"),
    Fact("tail", "34+b", "35+b", "4", "23+K", loc="2", calls="free_«k»"),
]
IMPORTS["python"] = "os,demo.«w»"
EDGES["python"] = [("Part«k»", "Base")]

BODY_LINE["rust"] = "        x += 1;\n"
TEMPLATES["rust"] = '''//! Crate docs for «w».
use std::collections::HashMap;
use crate::{parts::Part, io as disk};

pub struct Part«k»<'a> { label: &'a str, size: [u8; «s»] }

impl<'a> Sized for Part«k»<'a> {
    /// First line.
    /// Weighs part «k» {.
    #[inline]
    fn skipped(&self) -> u32 { 0 }

    /// Not this line.
    /// Adds sizes.
    pub async unsafe fn add<T: Fn(i32) -> i32>(&mut self, mut x: i32, (a, b): (u8, u8), f: T) -> Result<i32, String> where T: Clone {
        let open = '{'; let raw = r#"quote " brace {"#;
«b»        let g = |v: i32| { fn nested(q: &'static str) -> usize { q.len() } v + x };
        if x > 0 { Ok(g(x)) } else { Err(format!("{}", open)) }
    }
}

trait Shape { fn area(&self) -> f64; fn twice(&self) -> f64 { self.area() * 2.0 } }

/* plain /* a /* b /* c /* fn d() { */ */ } */ */ note */
pub(crate) extern "C" fn free_«k»(size: [u8; 4]) -> u8 { size[0] }
'''
FACTS["rust"] = [
    Fact("skipped", "11", "11", "4", "34", "", None, "impl", "method", return_type="u32", attributes="#[inline]", types_used="u32"),
    Fact("add", "15", "19+b", "4", "5", "x,(a, b),f", "Adds sizes.", "impl", "method", "pub,async,unsafe", loc="5+b",
         complexity="3", return_type="Result<i32, String>", calls="len,Ok,g,Err", types_used="i32,u8,T,Result,String"),
    Fact("nested", "17+b", "17+b", "27", "74", "q", None, "impl", "method", return_type="usize", calls="len",
         types_used="str,usize"),
    Fact("twice", "22+b", "22+b", "37", "81", return_type="f64", calls="area", types_used="f64"),
    Fact("free_«k»", "25+b", "25+b", "0", "63+K", "size", None, modifiers="pub", return_type="u8", types_used="u8"),
]
IMPORTS["rust"] = "std::collections::HashMap,crate::{parts::Part, io as disk}"
EDGES["rust"] = [("Part«k»", "Sized")]

BODY_LINE["go"] = "\tp.Size++\n"
TEMPLATES["go"] = '''// Package docs.
package «w»

import (
\t"fmt"
\tstr "strings"
)

type Part«k» struct { Size int; Tags map[string]struct{} }

// Not the doc.
// Add adds sizes.
func (p *Part«k») Add(a, b int, _ string, rest ...int) (int, error) {
\tvar any interface{} = `raw { " `
«b»\tif a > b && p.Size != «s» {
\t\treturn a, fmt.Errorf("bad %d }", a) // note
\t} else if any == nil { return b, nil }
\trun := func(x int) int { return x + 1 }
\treturn run(b), nil
}

/* block note */
func Free«k»(f func(int) int, m map[string]int) interface{} { return f(m["a"]) }

var total = 1 // trailing
func plain(int, string) {}
'''
FACTS["go"] = [
    Fact("Add", "13", "20+b", "0", "1", "a,b,_", "Add adds sizes.", "method", "method", loc="8+b", complexity="4",
         return_type="(int, error)", calls="Errorf,run", comments="// note", types_used="int,string,error"),
    Fact("Free«k»", "23+b", "23+b", "0", "77+K", "f,m", None, return_type="interface{}", calls="f", types_used="int,string"),
    Fact("plain", "26+b", "26+b", "0", "26", types_used=""),
]
IMPORTS["go"] = "fmt,strings"
EDGES["go"] = []

BODY_LINE["java"] = "        size += 1;\n"
TEMPLATES["java"] = '''package demo.«w»;

import java.util.List;
import static java.lang.Math.max;

/** Holder for part «k». */
public class Part«k» extends Base<String> implements Runnable, Sized {
    private int size = «s»;

    /**
     * Builds the part.
     * Size is { fixed }.
     */
    public Part«k»(int size, String label) {
        this.size = size; // not a brace }
    }

    @Override
    public static <T> List<T> scan«k»(List<? extends T> items, final Map<String, Integer> seen, int... rest) throws IOException {
        String text = "{ \\" ( ";
«b»        for (int i = 0; i < items.size(); i++) {
            if (seen.get(i) > 0 && rest.length > 1) { size--; } else { size++; }
        }
        Runnable r = new Runnable() {
            /* é */ public void run() { track(«k»); }
        };
        return items;
    }

    abstract int weigh(double factor);
}

interface Sized«k» {
    // plain note
    int size();
}
'''
FACTS["java"] = [
    Fact("Part«k»", "14", "16", "4", "5", "size,label", "Builds the part. Size is { fixed }.", "class", "constructor", "public",
         loc="3", comments="// not a brace }", types_used="int,String"),
    Fact("scan«k»", "18", "28+b", "4", "5", "items,seen", None, "class", "method", "public,static", loc="10+b", complexity="4",
         comment_lines="1",
         return_type="List<T>", calls="size,get,Runnable,track", comments="/* é */", attributes="@Override",
         types_used="List,T,Map,String,Integer,int"),
    Fact("run", "25+b", "25+b", "21", "51+K", "", None, "class", "method", "public", return_type="void", calls="track",
         types_used="void"),
    Fact("weigh", "30+b", "30+b", "4", "38", "factor", None, "class", "method", "abstract", return_type="int",
         types_used="double,int"),
    Fact("size", "35+b", "35+b", "4", "15", "", None, "global", "method", return_type="int", types_used="int"),
]
IMPORTS["java"] = "java.util.List,java.lang.Math.max"
EDGES["java"] = [("Part«k»", "Base<String>"), ("Part«k»", "Runnable"), ("Part«k»", "Sized")]

BODY_LINE["c"] = "    n++;\n"
TEMPLATES["c"] = '''#include <stdio.h>
#include "«w».h"
#define WRAP(x) do { x; \\
  } while (0

struct part { int size; };

/**
 * Adds sizes.
 * Keeps { braces }.
 */
static inline int add_«k»(const struct part *p, unsigned int n, char names[«s»][8], int (*cb)(int, void *), void *) {
    char c = '}'; /* tail { */
«b»    for (n = 0; n < 3; n++) { if (cb(n, p)) return n; }
    switch (n) { case 1: return 2; default: break; }
    return n > 1 ? 2 : 0;
}

// plain
char **names_«k»(int count)
{
    return count?0:make(count);
}

int table[] = { 1, 2 };
/** Not the doc. */
#ifdef SIZE
void reset(void) { log_("x)"); }
#endif
'''
FACTS["c"] = [
    Fact("add_«k»", "12", "17+b", "0", "1", "p,n,names,cb", "Adds sizes. Keeps { braces }.", modifiers="static,inline",
         loc="6+b", complexity="5", return_type="int", calls="cb", comments="/* tail { */",
         types_used="part,unsigned,int,char,void"),
    Fact("names_«k»", "20+b", "23+b", "0", "1", "", None, loc="4", complexity="2", return_type="char **", calls="make",
         types_used="int,char"),
    Fact("reset", "28+b", "28+b", "0", "32", return_type="void", calls="log_", types_used="void"),
]
IMPORTS["c"] = "stdio.h,«w».h"
EDGES["c"] = []

BODY_LINE["cpp"] = "        size_ += 1;\n"
TEMPLATES["cpp"] = '''#include <vector>
namespace «w» {
class Part«k» : public Base, private virtual Sized {
public:
    /** Makes it. */
    explicit Part«k»(int size = 3, std::string name = "{") : size_{size}, name_(name) { init(); }
    virtual ~Part«k»() override {}
    Part«k»(const Part«k»&) = delete;
    template <typename T>
    static std::vector<T> scan(const std::vector<T>& items, int* p, Map<int, T> seen) const noexcept {
        auto f = [&](int x) { return x > 0 ? 1 : 2; };
«b»        try { for (auto& i : items) { f(1); } } catch (...) { throw; }
        return {};
    }
    bool operator==(const Part«k»& o) const { return true; }
private:
    int size_;
};
int& Part«k»::at(int i) { return size_; }
}  // namespace
enum class Color { RED, GREEN };
/**
 * Free one.
 */
inline auto free_«k»(int a, unsigned) -> int { return a; }
'''
FACTS["cpp"] = [
    Fact("Part«k»", "6", "6", "4", "94+K", "size,name", "Makes it.", "class", "constructor", calls="name_,init",
         types_used="int,string"),
    Fact("unknown", "7", "7", "4", "31+K", "", None, "class", "method", "virtual"),
    Fact("Part«k»", "8", "8", "4", "31+2*K", "", None, "class", "constructor", types_used="Part«k»"),
    Fact("scan", "10", "14+b", "4", "5", "items,p,seen", None, "class", "method", "static", loc="5+b", complexity="3",
         return_type="std::vector<T>", calls="f", types_used="vector,T,int,Map"),
    Fact("unknown", "15+b", "15+b", "4", "57+K", "o", None, "class", "method", return_type="bool", types_used="Part«k»,bool"),
    Fact("at", "19+b", "19+b", "0", "38+K", "i", None, return_type="int&", types_used="int"),
    Fact("free_«k»", "25+b", "25+b", "0", "55+K", "a", "Free one.", modifiers="inline", return_type="int",
         types_used="int,unsigned"),
]
IMPORTS["cpp"] = "vector"
EDGES["cpp"] = [("Part«k»", "Base"), ("Part«k»", "Sized")]


# Stand-ins for characters that the two SQL dialects escape differently.
_STAND_INS = {"\n": "¶", "\t": "⇥", "'": "¤", "\\": "⧵"}


def text_sql(template: str, body_line: str = "") -> str:
    """Nested ``replace`` over one literal, valid in Spark and DuckDB."""
    slots = {"«b»": f"repeat({_literal(body_line)}, {BODY_COUNT})", "«k»": KEY, "«w»": WORD, "«s»": "cast(p_size as string)"}
    sql = _literal(template)
    for slot, value in slots.items():
        if slot in template:
            sql = f"replace({sql}, '{slot}', {value})"
    return sql


def _literal(text: str) -> str:
    """SQL string without escapes."""
    plain = text
    for char, stand_in in _STAND_INS.items():
        plain = plain.replace(char, stand_in)
    sql = f"'{plain}'"
    for char, stand_in in _STAND_INS.items():
        if char in text:
            sql = f"replace({sql}, '{stand_in}', chr({ord(char)}))"
    return sql


def number_sql(expression: str) -> str:
    swapped = re.sub(r"\bb\b", BODY_COUNT, expression)
    return re.sub(r"\bK\b", f"length({KEY})", swapped)


def path_sql() -> str:
    """``src/`` or ``build/`` path with the suffix of the language."""
    folder = f"CASE {VARIANT} WHEN 4 THEN 'build/' WHEN 5 THEN 'build/keep/' ELSE 'src/' END"
    suffix = "CASE p_partkey % 6 " + " ".join(
        f"WHEN {i} THEN '{SUFFIX[lang]}'" for i, lang in enumerate(LANGUAGES)) + " END"
    shown = f"CASE WHEN {VARIANT} = 2 THEN upper({suffix}) ELSE {suffix} END"
    return f"concat({folder}, {WORD}, '/part_', {KEY}, '.', {shown})"


def raw_text_sql() -> str:
    body = "CASE p_partkey % 6 " + " ".join(
        f"WHEN {i} THEN {text_sql(TEMPLATES[lang], BODY_LINE[lang])}" for i, lang in enumerate(LANGUAGES)) + " END"
    return (f"CASE {VARIANT} WHEN 1 THEN replace({body}, chr(10), concat(chr(13), chr(10))) "
            f"WHEN 3 THEN concat({body}, chr(10), '((', chr(10)) ELSE {body} END")


def joined_sql(template: str, body_line: str = "") -> str:
    """The text of ``text_sql`` for Spark, as the template's parts and values in a row.

    ``replace`` looks at every byte of a text once for each placeholder, this at none.
    """
    # ``text_sql`` puts sizes in last, so also into a word that holds the placeholder of one.
    word = f"replace({WORD}, '«s»', cast(p_size as string))" if "«s»" in template else WORD
    values = {"«k»": KEY, "«w»": word, "«s»": "cast(p_size as string)"}
    if "«b»" in template:
        values["«b»"] = f"repeat({joined_sql(body_line)}, {BODY_COUNT})"
    parts = [values.get(part) or _literal(part) for part in re.split("(«[bkws]»)", template) if part]
    return f"concat({', '.join(parts)})"


def raw_text_joined_sql() -> str:
    """``raw_text_sql`` for Spark: the same texts, each built once."""
    body = "CASE p_partkey % 6 " + " ".join(
        f"WHEN {i} THEN {joined_sql(TEMPLATES[lang], BODY_LINE[lang])}" for i, lang in enumerate(LANGUAGES)) + " END"
    # One mention of the body, or Spark would build the code of all templates three times.
    return (f"element_at(transform(array({body}), body -> CASE {VARIANT} WHEN 1 THEN replace(body, chr(10), concat(chr(13), chr(10))) "
            f"WHEN 3 THEN concat(body, chr(10), '((', chr(10)) ELSE body END), 1)")


def dealt(part: DataFrame) -> DataFrame:
    """Keys, names and sizes of ``part`` over all tasks, before they become texts.

    These rows are small beside their texts, and the table may be one row group,
    which a single task would read, render and filter.  The rows pass a generator
    behind the exchange: filters on what is rendered from them would else be
    pushed below the exchange, and the texts with them into that task.
    """
    partitions = int(part.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = part.select("p_partkey", "p_name", "p_size").repartition(partitions)
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def raw_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, text, content)`` of every part, as a scan would find them."""
    part = dealt(spark.read.parquet(f"{sf_dir}/part.parquet"))
    rendered = part.select(F.expr(path_sql()).alias("path"), F.expr(raw_text_joined_sql()).alias("text"), "p_partkey")
    planted = (
        F.when(F.col("p_partkey") % 7 == 3, F.concat(F.encode("text", "UTF-8"), F.lit(b"\x00")))
        .when(F.col("p_partkey") % 11 == 5, F.concat(F.encode("text", "UTF-8"), F.lit(b"\xff")))
        .otherwise(F.encode("text", "UTF-8"))
    )
    return rendered.select("path", "text", planted.alias("content"))


def facts_sql(columns: dict[str, str], languages=LANGUAGES, where: str = "true") -> str:
    """Union over all facts; ``columns`` maps output names to fact fields, '=SQL' or 'path'."""
    selects = []
    for i, lang in enumerate(LANGUAGES):
        if lang not in languages:
            continue
        for fact in FACTS[lang]:
            cells = [f"{_cell(fact, lang, field)} AS {name}" for name, field in columns.items()]
            selects.append(f"SELECT {', '.join(cells)} FROM part WHERE p_partkey % 6 = {i} AND {VARIANT} NOT IN (3, 4) AND {where}")
    return "\nUNION ALL\n".join(selects)


_NUMBERS = {"start", "end", "start_column", "end_column", "loc", "complexity", "comment_lines"}


def _cell(fact: Fact, lang: str, field: str) -> str:
    if field.startswith("="):
        return field[1:]
    if field == "path":
        return path_sql()
    if field == "language":
        return f"'{lang}'"
    if field == "imports":
        return text_sql(IMPORTS[lang])
    value = getattr(fact, field)
    if field in _NUMBERS:
        return f"cast({number_sql(value)} as bigint)"
    if value is None:
        return "cast(NULL as varchar)"
    return text_sql(value)
