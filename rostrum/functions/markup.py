"""HTML elements and texts, as far as extraction needs them.

A page is cut into the tags of the elements asked for and the markup between them. Each tag's depth is the
sum of its container's start and end tags before it, and an element reaches from its start tag to the
next tag of its depth that ends it: its own end tag or, where that may be left out, a tag that HTML lets end
it. So elements may be nested, and cells, rows, items, paragraphs and links unclosed. An element that
nothing ends reaches to the end of the markup. Tags in comments, scripts and styles do not count. Sums
take log n passes, so a page costs n log n in its tags, and the length of each element's markup.

All functions but :func:`unescape` return markup as it stands, NULL for NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A value ends at its own kind of quote; one without quotes at white space or the tag's end.
_VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
_REFERENCE = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
# To the end of a tag: a quoted value may hold what would end it.
_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""
_HIDDEN = r"<!--.*?(?:-->|\z)|<(script|style)(?=[\s>]).*?(?:</\1\s*>|\z)"
_ANY_TAG = rf"(?is){_HIDDEN}|</?[a-z]{_REST}"
# Set around the tags of a page, which is then split without a pattern.
_EDGE = "\x01"

# Elements that hold nothing, and those that end a paragraph.
_VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
_BLOCKS = ("address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "header", "main", "nav",
           "ol", "section", "table", "ul")
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_GROUPS = ("tbody", "thead", "tfoot")


@dataclass(frozen=True)
class _Kind:
    """How elements of a tag end: ``within`` are the containers that hide what is inside them, ``ends`` the
    tags that end one. ``opens``: the start of a container ends one too."""

    within: tuple[str, ...]
    ends: tuple[str, ...]
    opens: bool = False


# HTML's elements whose end tags may be left out. Links end where the next one begins.
_KINDS = {
    **dict.fromkeys(("td", "th"), _Kind(("table",), ("td", "th", "tr", *_GROUPS))),
    "tr": _Kind(("table",), ("tr", *_GROUPS)),
    **dict.fromkeys(_GROUPS, _Kind(("table",), _GROUPS)),
    "caption": _Kind(("table",), ("caption", "tr", "td", "th", *_GROUPS)),
    "li": _Kind(("ol", "ul"), ("li",)),
    "p": _Kind(_BLOCKS, ("p", *_HEADINGS), opens=True),
    "a": _Kind((), ("a",)),
}


def let(value: Column, fn: Callable[[Column], Column] | str) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` uses it; a text is a lambda in SQL,
    which takes one call to build instead of one per operation."""
    made = F.transform(F.array(value), fn) if callable(fn) else F.call_function("transform", F.array(value), F.expr(fn))
    return F.get(made, F.lit(0))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _among(values: tuple[str, ...] | list[str]) -> str:
    return "(" + ", ".join(map(_text, values)) + ")"


def _bound(value: str, name: str, body: str) -> str:
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _sums(steps: str) -> str:
    """Running sums, in as many passes as the length has binary digits."""
    passes = "cast(ceil(log2(greatest(size(steps), 1))) AS int)"
    reach = f"slice(array({', '.join(str(1 << k) for k in range(31))}), 1, {passes})"
    return _bound(steps, "steps", f"aggregate({reach}, steps, (s, by) -> transform(s, (x, i) -> x + if(i >= by, get(s, i - by), 0)))")


def _cut(c: Column, pattern: str) -> Column:
    """The markup before, between and after the tags that match, and in turn with it the tags: tag ``i`` is at ``2 i + 1``."""
    marked = F.split(F.regexp_replace(c, pattern, f"{_EDGE}$0{_EDGE}"), _EDGE, -1)
    heads, texts = F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), F.split(c, pattern, -1)
    paired = F.flatten(F.zip_with(texts, heads, lambda t, h: F.array(t, F.coalesce(h, F.lit("")))))
    return F.when(F.contains(c, F.lit(_EDGE)), paired).otherwise(marked)


_TAGS = "((size(page) - 1) DIV 2)"


def elements(c: Column, tag: str, with_attributes: str = "") -> Column:
    """``array<struct<head, inner, depth>>`` of every element of a tag in page order: its start tag, its
    inner markup, and how many containers of its kind (:data:`_KINDS`, else its own tag) are around it.

    ``with_attributes`` is a pattern that the start tag must match.
    """
    kind = _KINDS.get(tag, _Kind((tag,), ()))
    names = sorted({tag, *kind.within, *kind.ends})
    opening, closing = _among(kind.within or ("",)), _among(["/" + t for t in kind.within] or ("",))
    # a container's end tag counts as inside it; its start tag too, unless it ends elements itself
    own = tag in kind.within
    shift = f"CASE WHEN m.name IN {closing} THEN {0 if own else 1} WHEN m.name IN {opening} THEN {-1 if own or kind.opens else 0} ELSE 0 END"
    step = f"CASE WHEN m.name IN {opening} THEN 1 WHEN m.name IN {closing} THEN -1 ELSE 0 END"
    # a page without tags has one mark without a name, which is left out
    marks = (f"filter(transform(sequence(0, greatest({_TAGS} - 1, 0)), i -> struct(cast(i AS int) AS pos, "
             "lower(regexp_extract(get(page, cast(2 * i + 1 AS int)), '^<(/?[A-Za-z][A-Za-z0-9]*)', 1)) AS name)), "
             "m -> m.name NOT IN ('', 'script', 'style'))")
    events = f"sort_array(transform(marks, (m, k) -> struct(get(sums, k) + {shift} AS depth, m.pos AS pos, m.name AS name)))"
    reach = (f"transform(events, (e, k) -> struct(e.pos AS pos, if(get(events, k + 1).depth = e.depth, get(events, k + 1).pos, cast({_TAGS} AS int)) AS stop, "
             "e.depth AS depth, e.name AS name))")
    wanted = f"e.name = {_text(tag)}" + (f" AND get(page, 2 * e.pos + 1) RLIKE {_text('(?is)' + with_attributes)}" if with_attributes else "")
    inner = "array_join(slice(page, 2 * e.pos + 3, 2 * (e.stop - e.pos) - 1), '')"
    found = f"transform(sort_array(filter({reach}, e -> {wanted})), e -> struct(get(page, 2 * e.pos + 1) AS head, {inner} AS inner, e.depth AS depth))"
    body = _bound(marks, "marks", _bound(_sums(f"transform(marks, m -> {step})"), "sums", _bound(events, "events", found)))
    pattern = rf"(?is){_HIDDEN}|</?(?:{'|'.join(names)})(?=[\s/>]){_REST}"
    return F.when(c.isNotNull(), let(_cut(c, pattern), f"page -> {body}"))


def is_flat(c: Column, tag: str) -> Column:
    """Whether every element of a tag has its end tag before the next one starts, and no markup is hidden:
    then elements are what lies between start and end tags, and patterns find them without a tree."""
    # a pattern over the page could look for an end tag from every start anew, so the order of tags is looked at
    order = F.array_join(F.regexp_extract_all(c, F.lit(rf"(?i)(</?){tag}(?=[\s/>])"), F.lit(1)), ",")
    return ~c.rlike("(?i)<!--|<script|<style") & order.rlike("^(?:<,</(?:,<,</)*+)?$")


def blocks(c: Column, tag: str, with_attributes: str = "", own: bool = False) -> Column:
    """Inner markup of every element of a tag, in page order. ``own``: only of those in no container of
    their kind, such as the rows of a table's markup without the rows of tables inside it."""
    def found(c: Column) -> Column:
        every = elements(c, tag, with_attributes)
        if own:
            every = F.filter(every, lambda e: e["depth"] == 0)
        flat = F.when(_is_plain(c, tag, own), flat_blocks(c, tag, with_attributes))
        if not with_attributes and tag not in _KINDS.get(tag, _Kind((tag,), ())).within:
            flat = flat.when(_is_open(c, tag), _open_blocks(c, tag))
        return flat.otherwise(F.transform(every, lambda e: e["inner"]))

    return let(c, found)


def own_element(c: Column, tag: str) -> Column:
    """``struct<head, inner>`` of the first element of a tag in no container of its kind, else NULL."""
    def found(c: Column) -> Column:
        # the first tag of all, with nothing but text up to its end tag
        sole = rf"(?is)^[^<]*+(<{tag}(?=[\s/>]){_REST})([^<]*+)</{tag}(?=[\s/>]){_REST}"
        led = F.struct(F.regexp_extract(c, sole, 1).alias("head"), F.regexp_extract(c, sole, 2).alias("inner"))
        plain = F.struct(F.regexp_substr(c, F.lit(rf"(?is)<{tag}(?=[\s/>]){_REST}")).alias("head"), first(flat_blocks(c, tag)).alias("inner"))
        tree = let(first(F.filter(elements(c, tag), lambda e: e["depth"] == 0)),
                   lambda e: F.struct(e["head"].alias("head"), e["inner"].alias("inner")))
        return let(F.when(c.rlike(sole), led).when(_is_plain(c, tag, True), plain).otherwise(tree), lambda e: F.when(e["head"].isNotNull(), e))

    return let(c, found)


def _is_plain(c: Column, tag: str, own: bool) -> Column:
    """Whether patterns find a tag's elements, or its ``own`` ones."""
    kind = _KINDS.get(tag, _Kind((tag,), ()))
    if own and tag in kind.within:
        return F.lit(False)
    plain = is_flat(c, tag)
    if (own and kind.within) or kind.opens:
        plain = plain & ~c.rlike(rf"(?i)<(?:{'|'.join(kind.within)})[\s/>]")
    if kind.opens:
        plain = plain & ~F.array_join(flat_blocks(c, tag), "").rlike(rf"(?i)</?(?:{'|'.join(kind.ends)})[\s/>]")
    return plain


def _is_open(c: Column, tag: str) -> Column:
    """Whether markup has no container of a tag, hides nothing and starts no tag in another: then an element ends at the
    next tag that ends one."""
    containers = rf"|</?(?:{'|'.join(_KINDS[tag].within)})[\s/>]" if _KINDS[tag].within else ""
    return ~c.rlike(rf"(?i)<!--|<script|<style|<[^<>]*+<{containers}")


def _open_blocks(c: Column, tag: str) -> Column:
    """:func:`blocks` of markup that :func:`_is_open`, end tags left out or not."""
    names = "|".join(sorted({tag, *_KINDS[tag].within, *_KINDS[tag].ends}))
    return F.regexp_extract_all(c, F.lit(rf"(?is)<{tag}(?=[\s/>]){_REST}(.*?)(?=</?(?:{names})(?=[\s/>]){_REST}|\z)"), 1)


def flat_blocks(c: Column, tag: str, with_attributes: str = "") -> Column:
    """:func:`blocks` of markup whose elements are known to be flat."""
    start = rf"<{tag}(?=[\s/>])" + (rf"(?=[^>]*?{with_attributes})" if with_attributes else "") + _REST
    return F.regexp_extract_all(c, F.lit(rf"(?is){start}(.*?)</{tag}\s*>"), 1)


def _texts_at_depth_zero(step: str) -> str:
    """Of a page cut at its tags, the texts outside all elements; ``step`` is what a tag ``h`` adds to the depth."""
    heads = _bound("filter(page, (h, i) -> i % 2 = 1)", "heads", f"transform(heads, h -> {step})")
    return _bound(_sums(heads), "sums",
                  "transform(filter(page, (t, i) -> i % 2 = 0), (t, i) -> if(i = 0 OR get(sums, i - 1) <= 0, t, ''))")


def outside(c: Column, tag: str) -> Column:
    """The markup without the elements of a tag that it holds, such as a cell without tables in it."""
    step = f"CASE WHEN h RLIKE '(?i)^<{tag}' THEN 1 WHEN h RLIKE '^</' THEN -1 ELSE 0 END"
    kept = lambda c: let(_cut(c, rf"(?is){_HIDDEN}|</?{tag}(?=[\s/>]){_REST}"), f"page -> array_join({_texts_at_depth_zero(step)}, '')")
    return let(c, lambda c: F.when(c.rlike("(?i)<" + tag), kept(c)).otherwise(c))


def first(array: Column) -> Column:
    return F.get(array, F.lit(0))


def block(c: Column, tag: str, with_attributes: str = "") -> Column:
    """Inner markup of the first such element, else NULL."""
    return first(blocks(c, tag, with_attributes))


def attribute(start_tag: Column, name: str) -> Column:
    """Value of an attribute in markup that begins with its element."""
    found = F.regexp_extract(start_tag, rf"(?is)^\s*<[^>]*?\s{name}\s*=\s*{_VALUE}", 1)
    return F.nullif(unquoted(found), F.lit(""))


def unquoted(value: Column) -> Column:
    """An attribute's value without the quotes around it."""
    return F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")


def without_comments(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("<!--")), F.regexp_replace(c, r"(?s)<!--.*?(?:-->|\z)", "")).otherwise(c)


def links(c: Column) -> Column:
    """Targets of all links outside comments, in page order."""
    found = F.regexp_extract_all(without_comments(c), F.lit(rf"(?is)<a\b[^>]*?\shref\s*=\s*{_VALUE}"), 1)
    return F.transform(found, unquoted)


def first_matching(values: Column, pattern: str) -> Column:
    return first(F.filter(values, lambda v: v.rlike(pattern)))


def text_nodes(c: Column) -> Column:
    """Non-empty texts between tags, in page order."""
    bounded = F.concat(F.lit(">"), c, F.lit("<"))
    return F.regexp_extract_all(bounded, F.lit(r"(?s)>([^<>]+)<"), 1)


def own_text(c: Column) -> Column:
    """The first text of the element itself, before, between or after its children; NULL when there is none."""
    void = rf"(?i)^<(?:{'|'.join(_VOID)})(?=[\s/>])|/>$|^<!|^<(?:script|style)(?=[\s>])"
    step = f"CASE WHEN h RLIKE {_text(void)} THEN 0 WHEN h RLIKE '^</' THEN -1 ELSE 1 END"
    # before all children, or after children that hold nothing but text
    simple = rf"(?is)^(?:<([a-z][a-z0-9]*)(?=[\s>]){_REST}[^<]*</\1\s*>)*+([^<]+)"

    def found(c: Column) -> Column:
        later = let(_cut(c, _ANY_TAG), f"page -> get(filter({_texts_at_depth_zero(step)}, t -> t <> ''), 0)")
        return F.coalesce(F.nullif(F.regexp_extract(c, simple, 2), F.lit("")), F.when(F.contains(c, F.lit("<")), later))

    return let(c, found)


def cell_text(c: Column) -> Column:
    """A cell's own text, or all its text where it has only children."""
    return let(c, lambda c: let(own_text(c), lambda own: F.when(F.btrim(own) != "", own).otherwise(all_text(c))))


def all_text(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)<[^>]*>", "")


def unescape_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: unescape(F.col(name)) for name in columns})


def _character(code: Column) -> Column:
    """The character of a code point; U+FFFD where there is none."""
    fits = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(fits, code).otherwise(0xFFFD)), 8, "0")), "utf-32")


def unescape(c: Column) -> Column:
    """Character references by name, decimal or hexadecimal number, each decoded once; others stay."""
    codes = {**name2codepoint, "apos": 39}
    named = F.expr("map(" + ", ".join(f"'{name}', {code}" for name, code in codes.items()) + ")")

    def decoded(entry: Column) -> Column:
        name, part = entry["name"], entry["part"]
        digits = F.when(name.rlike("^#[0-9]{1,9}$"), F.substring(name, F.lit(2), F.length(name)).try_cast("bigint")) \
            .when(name.rlike("^#[xX][0-9a-fA-F]{1,7}$"), F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10).try_cast("bigint")) \
            .when(name.startswith("#"), F.lit(-1).cast("bigint")).otherwise(F.try_element_at(named, name).cast("bigint"))
        rest = F.substring(part, F.length(name) + 2, F.length(part))
        known = F.transform(F.array(F.when(name != "", digits)), lambda code: F.when(
            code.isNotNull(), F.concat(_character(code), rest)).otherwise(F.concat(F.lit("&"), part)))
        return F.get(known, F.lit(0))

    parts = F.transform(F.split(c, "&"), lambda p: F.struct(p.alias("part"), F.regexp_extract(p, _REFERENCE, 1).alias("name")))
    parts = F.transform(parts, lambda entry, i: F.when(i == 0, entry["part"]).otherwise(decoded(entry)))
    # most texts hold the commonest references only; &amp; last, so that nothing is decoded twice
    common = c
    for reference, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", "\xa0"), ("&#39;", "'"), ("&amp;", "&")):
        common = F.replace(common, F.lit(reference), F.lit(char))
    return F.when(~F.contains(c, F.lit("&")), c) \
        .when(c.rlike("&(?!(?:lt|gt|quot|nbsp|#39|amp);)"), F.array_join(parts, "")).otherwise(common)
