"""Rules and known edges of the extraction on hand-written samples."""

import pytest

from sourceloom.operators.chunks import marked_functions


def names(rows):
    return [r["name"] for r in rows]


def test_python_trailing_comments_and_one_liners(extract):
    rows = extract("python", "class A:\n  def f(self): return 1\n  def g(self):\n    x = 1\n    # mine\n  # not mine\n\ny = 2\n")
    assert [(r["name"], r["start_line"], r["end_line"], r["end_column"]) for r in rows] == [("f", 2, 2, 23), ("g", 3, 5, 10)]
    assert {r["scope"] for r in rows} == {"class"}


def test_python_parameters(extract):
    row, = extract("python", "def f(self, cls, a, b: int, c=1, d: str = 'x', *args, e, **kw): pass\n")
    assert row["arguments"] == ["cls", "a", "b", "c", "e"]


@pytest.mark.parametrize("body, doc", [
    ('    """Doc."""\n', "Doc."),
    ("    # note\n\n    'single'\n", "single"),
    ("    pass\n    'after pass'\n", "after pass"),
    ("    if x:\n        'inner'\n    'outer'\n", "outer"),
    ("    y = 1\n    'late'\n", None),
    ('    "a" "b"\n', None),
    ("    'x'.join(y)\n", None),
    ("    return 'no'\n", None),
    ("    r'raw'\n", "r'raw"),
])
def test_python_docstring(extract, body, doc):
    assert extract("python", f"def f(x):\n{body}    return 2\n")[0]["docstring"] == doc


def test_python_deep_brackets_continue_a_line(extract):
    deep = "[" * 12 + "\n1\n" + "]" * 12
    rows = extract("python", f"def f():\n    x = {deep}\n    return x\n\ndef g(): pass\n")
    assert [(r["name"], r["end_line"]) for r in rows] == [("f", 5), ("g", 7)]


def test_python_decorators_tabs_and_nesting(extract):
    rows = extract("python", "@dec(\n  1)\n# c\n@other\nasync def f():\n\tdef g():\n\t\treturn 1\n\treturn g\n")
    assert [(r["name"], r["start_line"], r["start_column"], r["end_line"]) for r in rows] == [("f", 5, 0, 8), ("g", 6, 1, 7)]
    assert rows[0]["attributes"][-1] == "@other"


def test_java_edges(extract):
    rows = extract("java", """enum E {
    RED { int code() { return 1; } }, BLUE() { };
    E() {}
    abstract int code();
    String s = """ + '"""\n  } text " block {\n"""' + """;
    Runnable r = () -> { if (x) { y(); } };
    int[] a = { 1, 2 };
    @Ann({"a", "b"}) @Other(value = ")") public void m(@Nonnull final int[] p, String q[], Object... rest) { }
    <T extends Comparable<T>> T max(T l) { return l; }
}
@interface Note { String value(); int n() default 1; }
interface I { int f(int a); default void g() { while (true) { return; } } }
record P(int x) { P { } int y() { return x; } }
""")
    found = {(r["name"], r["function_type"], r["scope"]) for r in rows}
    assert found == {("code", "method", "global"), ("E", "constructor", "class"), ("m", "method", "global"),
                     ("max", "method", "global"), ("f", "method", "global"), ("g", "method", "global"), ("y", "method", "global")}
    m = next(r for r in rows if r["name"] == "m")
    assert m["arguments"] == ["p", "q"]
    assert m["code"].startswith('@Ann({"a", "b"})') and m["modifiers"] == ["public"]
    assert sum(r["name"] == "code" for r in rows) == 2


def test_rust_edges(extract):
    rows = extract("rust", """macro_rules! m { ($x:expr) => { fn $x() {} } }
impl<T> Tr for S<T> where T: Fn(u8) -> u8 {
    /// Doc
    ///
    /// last
    fn new(self: Box<Self>, &(a, b): &(u8, u8), mut c: Vec<Option<u8>>, _: u8) -> Self { let s = "fn x() {"; let c = '"'; S }
    /* /* nested { */ } */
    extern fn e() {}
}
fn outer<'a>(x: &'a str) { fn inner() {} }
fn sig(f: fn(i32) -> i32);
""".replace("fn sig(f: fn(i32) -> i32);\n", "extern { fn sig(f: i32); }\n"))
    assert names(rows) == ["new", "e", "outer", "inner"]
    assert rows[0]["arguments"] == ["&(a, b)", "c", "_"] and rows[0]["docstring"] == "last"
    assert rows[1]["modifiers"] == ["extern"] and rows[1]["scope"] == "impl" and rows[1]["docstring"] is None
    assert rows[3]["scope"] == "global"


def test_go_edges(extract):
    rows = extract("go", """package p

func (s *Stack[T]) Push(v T) (err error) { s.x = append(s.x, v); return }
func Map[T any, U comparable](xs []T, f func(T) U) []U {
\treturn nil
}
func noNames(chan int, *T) {}
var f = func(a int) int { return a }
// doc // twice
func Multi(
\ta, b int,
\tc string,
) interface{} {
\tx := 'a' /* } */
\ts := "}" + `
}`
\treturn struct{}{}
}
""")
    assert [(r["name"], r["scope"], r["arguments"]) for r in rows] == [
        ("Push", "method", ["v"]), ("Map", "global", ["xs", "f"]), ("noNames", "global", []), ("Multi", "global", ["a", "b", "c"])]
    assert rows[3]["docstring"] == "doc // twice" and rows[3]["end_line"] == 18


def test_c_edges(extract):
    rows = extract("c", """#define BAD {
#if A
static int (*get(int which))(int a) { return 0; }
#endif
struct s { int x; } v = { 1 };
struct node *make(struct node *, unsigned long n, const char *const names[], void (*cb)(int), ...)
{
    do { x++; } while (x < 2);
    char c = '\\'';
    if (x) { for (;;) { } } else { }
    return 0;
}
extern "C" { int inner(void) { return 1; } }
enum { A, B };
""")
    assert names(rows) == ["unknown", "make", "inner"]
    assert rows[1]["arguments"] == ["n", "names", "cb"] and rows[0]["modifiers"] == ["static"]


def test_cpp_edges(extract):
    rows = extract("cpp", """namespace a::b {
template <typename T, int N = (3 > 2)>
class V final : public Base<T> {
  public:
    V() : a{}, b{1}, c(2) { }
    V(V&&) noexcept = default;
    operator bool() const { return true; }
    T& operator[](int i) { return a[i]; }
    int f() const override { auto g = [this](int q) { return q; }; return g(1'000); }
    virtual void pure() = 0;
    struct In { void h() { } };
};
}
A::B::C::~C() { }
void A::go(int a = f({1, 2}), char c = '{') try { } catch (...) { }
const char* raw() { return R"x(})")x"; }
int main() { struct L { int z() { return 1; } }; if (a) { } for (auto x : y) { } return 0; }
""")
    found = [(r["name"], r["function_type"]) for r in rows]
    assert found == [("V", "constructor"), ("V", "constructor"), ("unknown", "method"), ("unknown", "method"), ("f", "method"),
                     ("h", "method"), ("unknown", "function"), ("go", "function"), ("raw", "function"), ("main", "function"),
                     ("z", "method")]
    assert rows[0]["code"] == "V() : a{}, b{1}, c(2) { }"
    assert rows[7]["arguments"] == ["a", "c"]


@pytest.mark.parametrize("language, text", [
    ("python", "def f(:\n    pass\n"), ("python", "x = '''open\n"), ("rust", "fn f( { }\n"), ("go", "func f() {\n"),
    ("java", "class A { void f() { } } }\n"), ("c", "int f() { return (1]; }\n"), ("cpp", "int f() { /* open \n }\n"),
    ("c", "int f() { g({ 1); } }\n"),
])
def test_broken_files_yield_nothing(extract, language, text):
    assert extract(language, text) == []


def test_keep_mode_returns_unclosed_functions(extract):
    row, = extract("go", "package p\nfunc f(a int) {\n\tx()\n", on_error="keep")
    assert (row["name"], row["arguments"], row["start_line"], row["end_line"]) == ("f", ["a"], 2, 4)


def test_marks_tell_sound_functions_of_broken_files(spark):
    texts = [
        ("whole.go", "go", "package p\nfunc f() {}\n"),
        ("open.go", "go", "package p\nfunc f(a int) {\n\tx()\n}\n\nfunc g() {\n\ty(\n"),
        ("extra.c", "c", "int a() { return 1; }\nint b() {\n  return 2; }}\nint c() { return 3; }\n"),
        ("quote.java", "java", "class A {\n  int f() { return 1; }\n}\nclass B {\n  String g() { return \"x; }\n}\n"),
        ("call.py", "python", "def f():\n    return 1\ndef g():\n    return h(\n"),
        ("empty.c", "c", "")]
    files = spark.createDataFrame(texts, "path string, language string, text string")
    rows = marked_functions(files, columns=("file_path", "name", "end_line")).collect()
    got = {(r.file_path, r.name): (r.incomplete, r.reason) for r in rows}
    sound, brackets = (False, None), (True, "unbalanced brackets")
    assert got["whole.go", "f"] == got["open.go", "f"] == got["extra.c", "a"] == got["extra.c", "b"] == sound
    assert got["quote.java", "f"] == got["call.py", "f"] == sound
    assert got["open.go", "g"] == got["extra.c", "c"] == got["call.py", "g"] == brackets
    assert got["quote.java", "g"] == (True, "unterminated literal or comment")


def test_unset_and_empty_inputs(spark, extract):
    assert extract("java", "") == []
    assert extract("python", "# only a comment") == []
    with pytest.raises(ValueError):
        extract("java", "", on_error="ignore")


@pytest.mark.parametrize("language, text, found", [
    ("java", 'class A {\n  @JoinTable(joinColumns = {@JoinColumn(name="a")}, inverse = {@X({@Y({1, 2}), @Y({3})})})\n'
             '  public int getX(@P({@Q("a;{")}) int v) { return run(new R() { public void go() { a(); } }); }\n  int y() { return 1; }\n}\n',
     [("getX", ["v"], 2, 3), ("go", [], 3, 3), ("y", [], 4, 4)]),
    ("rust", "/* a /* b /* c /* d /* e /* fn no() { */ */ } */ */ */ */\nfn one(x: i32) -> i32 { x }\nfn two(y: Vec<Vec<Vec<Vec<Vec<Vec<u8>>>>>>, z: u8) {}\n",
     [("one", ["x"], 2, 2), ("two", ["y", "z"], 3, 3)]),
    ("cpp", "void f(A<B<C<D<E<F<G<int>>>>>>> x, int y) { }\nint g(int a = ((((((((((((1)))))))))))), int (*cb)(int)) { return 0; }\n",
     [("f", ["x", "y"], 1, 1), ("g", ["a", "cb"], 2, 2)]),
    ("python", 'def f(a=((((((((((((1)))))))))))), b: int, c={"x": [{"y": [{}]}]}):\n    return 1\ndef g(x): pass\n', [("f", ["a", "b", "c"], 1, 2), ("g", ["x"], 3, 3)]),
    ("go", "package p\nfunc f(a map[string][]map[int]func(x [][]int) ([]int, error), b int) {}\nfunc g(x interface{ M(int) }) {}\n",
     [("f", ["a", "b"], 2, 2), ("g", ["x"], 3, 3)]),
    ("c", "int f(int (*a)(int (*)(int (*)(int))), int b) { return ((((((((((((1)))))))))))); }\n", [("f", ["a", "b"], 1, 1)]),
])
def test_deep_nesting(extract, language, text, found):
    assert [(r["name"], r["arguments"], r["start_line"], r["end_line"]) for r in extract(language, text, columns=("name", "arguments", "start_line", "end_line", "start_column"))] == found
