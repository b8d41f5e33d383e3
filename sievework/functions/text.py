"""Text functions as column expressions."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACES = r"[ \t\n\r\f]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^ \t\n\r\f]+"))


def first_sentence(text: Column) -> Column:
    return F.element_at(F.split(text, r"(?<=[.!?])[ \t\n\r\f]+"), 1)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACES, " "))


def clean_social_caption(text: Column) -> Column:
    """Link mentions keep their name; URLs, hashtags and mentions go; spaces and stray punctuation are tidied; empty without a word."""
    t = F.regexp_replace(text, r"\[[^\]|]*\|([^\]]*)\]", "$1")
    t = F.regexp_replace(t, r"https?://[^ \t\n\r\f]+", "")
    t = F.regexp_replace(t, r"[#@][0-9A-Za-z_]+", "")
    t = F.regexp_replace(squeeze(t), r" +([,.;:!?])", "$1")
    return F.when(F.rlike(t, F.lit(r"[0-9A-Za-z_\p{L}]")), t).otherwise("")


def clean_import_caption(text: Column) -> Column:
    """A caption without links, hashtags and mentions; its lines are kept and tidied, those without a word go."""
    t = F.regexp_replace(text, r"(?i)(?:https?://|www\.)\S+|\b(?:t|telegram)\.me/\S+", " ")
    t = F.regexp_replace(t, r"(?U)(?<![\w&])#[\w-]+", " ")
    t = F.regexp_replace(t, r"(?U)(?<![\w@.])@\w{2,}", " ")
    tidy = lambda line: F.regexp_replace(F.btrim(F.regexp_replace(line, "[ \t]+", " "), F.lit(" \t\r")), r"\s+([,.;:!?])", "$1")
    lines = F.filter(F.transform(F.split(F.replace(t, F.lit("\r\n"), F.lit("\n")), "\n"), tidy), lambda line: F.rlike(line, F.lit(r"(?U)\w")))
    return F.array_join(lines, "\n")


def strip_markup(text: Column) -> Column:
    """Tags and line breaks to spaces, the common entities decoded, URLs and rules of repeated punctuation out, spaces squeezed, spaces,
    commas and semicolons off both ends."""
    t = F.regexp_replace(text, r"<[^>]+>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    t = F.regexp_replace(t, r"https?://[^ \t\n\r\f]+|www\.[^ \t\n\r\f]+", "")
    t = F.regexp_replace(t, r"-{4,}|_{4,}|={4,}|\*{4,}|~{4,}|\.{4,}|—{4,}|–{4,}", " ")
    return F.btrim(F.regexp_replace(t, SPACES, " "), F.lit(" ,;"))


@F.pandas_udf(T.StringType())
def decode_entities(text: pd.Series) -> pd.Series:
    """All named and numbered entities; only where they occur does a row need this."""
    return text.map(lambda s: html.unescape(s) if isinstance(s, str) else None)


def drop_segments(text: Column, separator: str, drop: str) -> Column:
    """Segments of a text without those that match ``drop``."""
    return F.array_join(F.filter(F.transform(F.split(text, separator), lambda s: F.trim(s)), lambda s: (s != "") & ~F.rlike(s, F.lit(drop))), ". ")


#: What marks a segment of a description as a link, and as one that is not about the picture.
SEGMENT_LINK = r"(?i)<a\b|https?://|www\.|#\d{4,}"
SEGMENT_DROP = (
    r"(?iu)разрешен|с согласия|©|copyright|все права|точка (стоит |поставлена )?(условн|примерн|приблизит)|ракурс условн"
    r"|^\s*вариант(?!\p{L})|более (ч[её]ткий|крупный|качественный) вариант|^\s*(см\.|смотри)\s"
)


def description(text: Column) -> Column:
    """A description without the segments (sentences, or lines cut by a tag) that hold a link or are not about the picture; empty for null."""
    parts = F.split(text, r"(?i)<br\s*/?>|(?<=[.!?])\s+(?=[A-ZА-ЯЁ0-9«\"(])")
    kept = F.transform(F.filter(parts, lambda s: ~F.rlike(s, F.lit(SEGMENT_LINK))), strip_markup)
    return F.coalesce(F.array_join(F.filter(kept, lambda s: (s != "") & ~F.rlike(s, F.lit(SEGMENT_DROP))), " "), F.lit(""))


def cap_text(text: Column, most: int) -> Column:
    """At most ``most`` characters, cut at the last space and before punctuation there, with an ellipsis if cut."""
    head = F.rtrim(F.regexp_replace(F.left(text, F.lit(most)), " [^ ]*$", ""), F.lit(" ,;:"))
    return F.when(F.char_length(text) > most, F.concat(head, F.lit("..."))).otherwise(text)


def compose_caption(parts: list[Column]) -> Column:
    """One line of sentences from ordered parts; what an earlier part already says is left out, every part ends with a stop."""
    filled = F.filter(F.array(*[F.trim(p) for p in parts]), lambda p: p.isNotNull() & (p != ""))

    def add(acc, p):
        said = F.contains(F.lower(acc), F.lower(p))
        ended = F.when(F.rlike(p, F.lit("[.!?]$")), p).otherwise(F.concat(p, F.lit(".")))
        return F.when(said, acc).when(acc == "", ended).otherwise(F.concat_ws(" ", acc, ended))

    return F.aggregate(filled, F.lit(""), add)


#: Latin, Greek and small-capital letters and the Cyrillic letters that they look like, one below the other.
LOOKALIKES = (
    "aceopxyACEHKMOPTXBĸᴏοᴍëΓᴙᴦʜΒΜκΚɜΗΠ",
    "асеорхуАСЕНКМОРТХВкоомёГягнВМкКзНП",
)


def repair_homoglyphs(text: Column) -> Column:
    """Look-alikes become Cyrillic in words (runs of letters, digits and underscores) that hold Russian letters."""
    runs = F.split(text, r"(?U)(?<=\w)(?=\W)|(?<=\W)(?=\w)")
    fixed = F.transform(runs, lambda w: F.when(F.rlike(w, F.lit("[а-яёА-ЯЁ]")), F.translate(w, *LOOKALIKES)).otherwise(w))
    return F.array_join(fixed, "")


def drop_emoji(text: Column) -> Column:
    return squeeze(F.replace(F.regexp_replace(text, r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{FE0F}]", ""), F.lit(" "), F.lit(" ")))


#: Calls to subscribe.
FOOTER_CALL = r"(?iu)подписывайтесь|подписывайся|подпишитесь|переходите|присоединяйтесь|(?<!\p{L})в\s+(МАХ|MAX)(?!\p{L})"


def footer_line(line: Column, channel: str = "", link_texts: Column | None = None, call: str = FOOTER_CALL) -> Column:
    """Whether a line is a channel's footer: its name, alone or before a bar, a bare URL, the text of a link to the channel, or a call to
    subscribe of at most twelve words."""
    core = F.btrim(F.rtrim(F.btrim(line), F.lit(":!.")))
    out = F.rlike(core, F.lit(r"^https?://\S+$")) | ((word_count(core) <= 12) & F.rlike(core, F.lit(call)))
    if channel:
        out = out | (F.lower(core) == channel.lower()) | F.startswith(F.lower(core), F.lit(channel.lower() + " |"))
    return out if link_texts is None else out | F.coalesce(F.array_contains(link_texts, core), F.lit(False))


def strip_footer(lines: Column, is_footer) -> Column:
    """An array of lines without the run of footer or blank lines at its end; ``is_footer`` takes a line."""

    def step(acc, line):
        foot = is_footer(line) | (F.trim(line) == "")
        return F.struct((acc["open"] & foot).alias("open"), F.when(acc["open"] & foot, acc["kept"]).otherwise(F.concat(F.array(line), acc["kept"])).alias("kept"))

    none = F.array().cast("array<string>")
    return F.aggregate(F.reverse(lines), F.struct(F.lit(True).alias("open"), none.alias("kept")), step, lambda acc: acc["kept"])


#: Words before a full stop that ends no sentence.
ABBREVIATIONS = (
    "г гг ул пл им др см км св ст руб коп тыс млн млрд худ обл пр просп пер наб ок вв стр рис фот акад проф ген "
    "тов т е д н э р с ж ср см мм кв ред изд арх"
).split()
ENGLISH_ABBREVIATIONS = ("mr", "mrs", "dr", "st", "etc", "vs", "fig", "no")


def sentences(text: Column, also: tuple[str, ...] = ()) -> Column:
    """Sentences. Stops, with closing quotes and brackets, end one before white space and a capital letter, digit, opening quote, bracket or
    dash; a full stop does not after an initial or an abbreviation (``also`` adds some). White space is looked for first, as it is rarer
    than places to look back from."""
    words = "|".join([*dict.fromkeys(ABBREVIATIONS), *also])
    guard = rf'(?<!(?<!\w)(?:(?iu:{words})|\w)\.[.!?…]{{0,4}}[»"”)]{{0,3}})'
    parts = F.split(text, rf'(?U)(?=\s)(?<=[.!?…][»"”)]{{0,3}}){guard}\s+(?=[\p{{Lu}}\d«"“„(—–-])')
    return F.filter(F.transform(parts, lambda s: F.btrim(s, F.lit(" \t\r\n\f"))), lambda s: s != "")


#: A question at the end of a sentence, and a tag that makes a statement one.
QUESTION = r"\?[?!»\"”)\s.]*$"
QUESTION_TAG = (
    r"(?iu),\s*(а\s+)?(вы\s+)?((помните|узнали|узна[её]те)(\s+[\p{L}\p{N}_-]+){0,2}|правда|не так ли|согласны|верно|да)\s*\?[?!.]*$"
)


def end_with_stop(s: Column) -> Column:
    bare = F.rtrim(s, F.lit(" ,;:—–-!…"))
    return F.when(F.endswith(bare, F.lit(".")), bare).otherwise(F.concat(bare, F.lit(".")))


def trim_questions(text: Column, also: tuple[str, ...] = ()) -> Column:
    """Sentences without questions; one that is a question by its tag alone stays as a statement. What is left ends with a full stop. The
    text itself if no question was there or fewer than three words are left."""

    def asks(s):
        return F.contains(s, F.lit("?")) & F.rlike(s, F.lit(QUESTION))

    def keep(s):
        stated = F.btrim(F.regexp_replace(s, QUESTION_TAG, ""))
        return F.when(~asks(s), s).when((stated != s) & (stated != ""), end_with_stop(stated))

    def choose(every):
        left = F.when(F.exists(every, asks), F.array_join(F.array_compact(F.transform(every, keep)), " "))
        return once(left, lambda kept: F.when(word_count(kept) >= 3, end_with_stop(kept)).otherwise(text))

    return once(sentences(text, also), choose)


def truncate_words(text: Column, budget: int) -> Column:
    """Whole sentences while they fit a word budget; the first always stays."""

    def step(acc, s):
        n = acc["n"] + word_count(s)
        fits = ~acc["full"] & ((acc["n"] == 0) | (n <= budget))
        return F.struct(F.when(fits, n).otherwise(acc["n"]).alias("n"), (acc["full"] | ~fits).alias("full"), F.when(fits, F.concat(acc["kept"], F.array(s))).otherwise(acc["kept"]).alias("kept"))

    start = F.struct(F.lit(0).alias("n"), F.lit(False).alias("full"), F.array().cast("array<string>").alias("kept"))
    return F.array_join(F.aggregate(sentences(text), start, step, lambda acc: acc["kept"]), " ")


def cut_before_sentence(text: Column, phrase: str) -> Column:
    """The text up to the sentence that holds a phrase; unchanged without it."""
    pattern = rf"(?is)^(.*?)(?:(?<=[.!?])\s+|^)(?:(?![.!?]\s).)*?{re.escape(phrase)}.*$"
    return F.when(F.rlike(text, F.lit(rf"(?i){re.escape(phrase)}")), F.rtrim(F.regexp_replace(text, pattern, "$1"))).otherwise(text)


def cut_before_script(text: Column, script: str = r"Ѐ-ӿ") -> Column:
    """The text up to the first sentence with a letter of the script; an opening quote goes with its sentence."""
    def head(every):
        first = F.array_position(F.transform(every, lambda s: F.rlike(s, F.lit(f"[{script}]"))), F.lit(True))
        return once(first, lambda at: F.array_join(F.when(at > 0, F.slice(every, F.lit(1), at.cast("int") - 1)).otherwise(every), " "))

    return once(sentences(text), head)


def medium(text: Column) -> Column:
    """Colour, black and white or ambiguous, by how a caption opens."""
    head = F.lower(F.left(text, F.lit(80)))
    bw = F.rlike(head, F.lit(r"^(?:an? )?(?:black[- ]and[- ]white|monochrome|grayscale|sepia)"))
    colour = F.rlike(head, F.lit(r"^(?:an? )?(?:full[- ])?colou?r(?:ed|ful)?\b"))
    return F.when(bw & ~colour, "bw").when(colour & ~bw, "color").otherwise("ambiguous")


def drop_medium(text: Column) -> Column:
    """Takes the medium word out of an opening and repairs the article before it."""
    found = r"(?i)^(an?) (?:black[- ]and[- ]white|monochrome|colou?r) ([a-z])"
    article = F.regexp_extract(text, found, 1)
    vowel = F.rlike(F.regexp_extract(text, found, 2), F.lit("(?i)[aeiou]"))
    new = F.when(F.startswith(article, F.lit("A")), F.when(vowel, "An").otherwise("A")).otherwise(F.when(vowel, "an").otherwise("a"))
    return F.when(article != "", F.concat(new, F.lit(" "), F.regexp_replace(text, r"(?i)^an? (?:black[- ]and[- ]white|monochrome|colou?r) ", ""))).otherwise(text)


def colour_mode(text: Column) -> Column:
    """What a long caption says about colour: the first rule that fits."""
    out = F.lit("unknown")
    for name, pattern in reversed((("bw", r"black[- ]and[- ]white|monochrome|grayscale"), ("sepia", r"sepia"), ("film", r"film|analog"), ("painting", r"painting|drawing"), ("color", r"colou?r"))):
        out = F.when(F.rlike(text, F.lit(rf"(?i)\b(?:{pattern})")), name).otherwise(out)
    return out


def failures(text: Column, least: int, most: int, banned: list[str]) -> Column:
    """Reasons why a caption fails, in order; none if it passes."""
    n = word_count(text)
    rules = [F.when(n < least, f"fewer than {least} words"), F.when(n > most, f"more than {most} words"), F.when(~F.rlike(F.trim(text), F.lit(r"[.!?]$")), "no final stop"), F.when(F.contains(text, F.lit("\n")), "line break")]
    rules += [F.when(F.contains(F.lower(text), F.lit(b)), f"banned: {b}") for b in banned]
    return F.array_compact(F.array(*rules))


def concepts(text: Column, table: dict[str, str]) -> Column:
    """Names of the rules whose pattern the text has."""
    return F.array_compact(F.array(*[F.when(F.rlike(text, F.lit(p)), n) for n, p in table.items()]))


def unsupported(reply: Column, source: Column, table: dict[str, str]) -> Column:
    """Concepts that a reply names and its source does not."""
    return F.array_except(concepts(reply, table), concepts(source, table))


#: Stems and endings of the Russian words for colour and black-and-white.
RU_MEDIUM = re.compile(r"(?<!\w)(?:цветн|ч[её]рно-бел)(?:ая|ое|ой|ые|ый|ую|ого|ому|ом|ых|ым|ыми|ою|ей)(?!\w)", re.IGNORECASE)


@F.pandas_udf(T.StringType())
def strip_russian_medium(text: pd.Series) -> pd.Series:
    """Captions whose Russian tail, after ``., ``, loses its medium words; a removed word's capital passes to the next word."""

    def one(s):
        if not isinstance(s, str):
            return None
        head, sep, tail = s.partition("., ")
        out, at, capital = [], 0, False
        for m in RU_MEDIUM.finditer(tail):
            piece = tail[at : m.start()]
            if capital and piece[:1].islower():
                piece = piece[0].upper() + piece[1:]
            at = m.end()
            if tail[at : at + 1] == " ":
                while tail[at : at + 1] == " ":
                    at += 1
            elif piece.endswith(" "):
                piece = piece[:-1]
            out.append(piece)
            capital = m.group()[0].isupper() or (capital and not piece)
        rest = tail[at:]
        if capital and rest[:1].islower():
            rest = rest[0].upper() + rest[1:]
        return head + sep + "".join(out) + rest

    return text.map(one)


def budgeted_prefix(budget: int, least: int = 8, separator: str = "__"):
    """A function of folder names that joins them within a budget: the deepest is shortened first, down to ``least``, then those above
    it, then the deepest go, and the root is cut last."""

    @F.pandas_udf(T.StringType())
    def prefix(parts: pd.Series) -> pd.Series:
        def shorten(p, n):
            return p[:n].rstrip("_-") or p[:n]

        def one(names):
            kept = [re.sub(r"[^A-Za-z0-9-]+", "_", str(n)).strip("_-") or "x" for n in names]
            size = lambda: len(separator.join(kept))
            for k in reversed(range(1, len(kept))):
                if size() > budget:
                    kept[k] = shorten(kept[k], max(least, len(kept[k]) - (size() - budget)))
            while len(kept) > 1 and size() > budget:
                del kept[-1]
            return separator.join(kept) if size() <= budget else shorten(kept[0], budget)

        return parts.map(one)

    return prefix


#: Latin letters for Cyrillic ones: Russian, then Ukrainian and Belarusian.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "yo", "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n",
    "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "",
    "э": "e", "ю": "yu", "я": "ya",
    "є": "ye", "і": "i", "ї": "yi", "ґ": "g", "ў": "u",
}


@F.pandas_udf(T.StringType())
def transliterate(text: pd.Series) -> pd.Series:
    """Latin letters for Cyrillic ones, in capitals where a neighbour is one too; accents off; any other letter outside ASCII an underscore."""

    def letter(before, c, after):
        latin = CYRILLIC.get(c.lower(), c)
        if latin is c or not c.isupper():
            return latin
        return latin.upper() if before.isupper() or after.isupper() else latin.capitalize()

    def one(s):
        if not isinstance(s, str):
            return None
        s = unicodedata.normalize("NFC", s)
        latin = "".join(map(letter, [" ", *s[:-1]], s, [*s[1:], " "])) if s else ""
        bare = "".join(c for c in unicodedata.normalize("NFKD", latin) if not unicodedata.combining(c))
        return re.sub(r"[^\x00-\x7f]", "_", bare)

    return text.map(one)


def clean_name(name: Column, most: int = 100) -> Column:
    """A folder-safe name."""
    t = F.regexp_replace(name, r'[\\/:*?"<>|\x00-\x1f]', "_")
    return F.left(F.btrim(F.regexp_replace(t, "_{2,}", "_"), F.lit(" ._")), F.lit(most))


def natural_key(name: Column) -> Column:
    """A key that sorts numbers inside names by value: every run of digits padded to 12."""
    padded = F.regexp_replace(F.lower(name), r"(\d+)", "000000000000$1")
    return F.regexp_replace(padded, r"\d*(\d{12})", "$1")


@F.pandas_udf(T.StringType())
def ascii_url(url: pd.Series) -> pd.Series:
    """Host in IDNA, the rest percent-encoded."""
    from urllib.parse import quote, urlsplit, urlunsplit

    def one(s):
        if not isinstance(s, str):
            return None
        try:
            p = urlsplit(s)
            host = (p.hostname or "").encode("idna").decode() + (f":{p.port}" if p.port else "")
        except (UnicodeError, ValueError):
            return None
        return urlunsplit((p.scheme, host, quote(p.path, safe="/%:@!$&'()*+,;=~"), quote(p.query, safe="=&%/?:@!$'()*+,;~"), ""))

    return url.map(one)


def strip_thinking(reply: Column) -> Column:
    """A model's reply without its thinking block and control tokens."""
    return F.trim(F.regexp_replace(F.regexp_replace(reply, r"(?s)<think>.*?</think>", ""), r"<\|[^|>]*\|>", ""))


def fill_template(template: str, values: dict[str, Column]) -> Column:
    out = F.lit(template)
    for k, v in values.items():
        out = F.replace(out, F.lit("{" + k + "}"), F.coalesce(v.cast("string"), F.lit("")))
    return out


def verdict_letter(reply: Column) -> Column:
    """Y, N or I from a letter or word at the front; null if it is none."""
    first = F.upper(F.regexp_extract(reply, r"^[^A-Za-z]*([A-Za-z])", 1))
    return F.when(first.isin("Y", "N", "I"), first)


@F.arrow_udf(T.StringType())
def _decode_other(raw: pa.Array) -> pa.Array:
    """Bytes that are not UTF-8: UTF-16 by its mark, else Windows-1251. A few rows at a time, so that a worker holds a batch and its result."""

    def one(b):
        if b is None:
            return None
        return str(b, "utf-16" if b[:2] in (b"\xff\xfe", b"\xfe\xff") else "cp1251", "replace")

    parts = [pa.array(map(one, raw[lo : lo + 256].to_pylist()), pa.string()) for lo in range(0, len(raw), 256)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def decode_text(raw: Column) -> Column:
    """Bytes as text: UTF-16 by its mark, UTF-8 with or without one, else Windows-1251. Only bytes that are not UTF-8 go through Python."""
    text = raw.cast("string")
    plain = F.is_valid_utf8(text)
    bare = F.when(F.startswith(text, F.lit("\ufeff")), F.substring(text, 2, 1 << 30)).otherwise(text)
    return F.coalesce(F.when(plain, bare), _decode_other(F.when(~plain, raw)))


@F.pandas_udf(T.StringType())
def first_json(text: pd.Series) -> pd.Series:
    """The first JSON array or object inside free text, as compact JSON; null without one."""
    import json

    decoder = json.JSONDecoder()

    def one(s):
        for m in re.finditer(r"[\[{]", s or ""):
            try:
                return json.dumps(decoder.raw_decode(s, m.start())[0], ensure_ascii=False, separators=(",", ":"), sort_keys=True)
            except ValueError:
                continue
        return None

    return text.map(one)


@F.pandas_udf(T.ArrayType(T.StringType()))
def json_strings(doc: pd.Series) -> pd.Series:
    """All string values of a JSON document, whatever their depth, in document order."""
    import json

    def walk(v):
        if isinstance(v, str):
            yield v
        elif isinstance(v, dict):
            for x in v.values():
                yield from walk(x)
        elif isinstance(v, list):
            for x in v:
                yield from walk(x)

    def one(s):
        try:
            return list(walk(json.loads(s)))
        except (TypeError, ValueError):
            return []

    return doc.map(one)


@F.pandas_udf(T.StringType())
def drop_paths(doc: pd.Series) -> pd.Series:
    """A JSON document without values that are local paths."""
    import json

    def clean(v):
        if isinstance(v, dict):
            return {k: clean(x) for k, x in v.items() if not is_path(x)}
        if isinstance(v, list):
            return [clean(x) for x in v if not is_path(x)]
        return v

    def is_path(v):
        return isinstance(v, str) and bool(re.match(r"(?:[A-Za-z]:[\\/]|/(?:home|root|mnt|Users)/|\\\\)", v))

    def one(s):
        try:
            return json.dumps(clean(json.loads(s)), ensure_ascii=False, sort_keys=True)
        except (TypeError, ValueError):
            return s

    return doc.map(one)
