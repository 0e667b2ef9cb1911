"""Template residue, filler, error pages and script notices in place of content.

Method: three kinds of evidence are put together for each document.
    * placeholder detectors over the whole text: unfilled fields in the usual
      template notations, filler words in a row, one word repeated, sentences
      that say they are filler;
    * blocks (paragraphs) that read as a notice of a server, program or browser:
      a subject (page, session, script, ...) with the predicate that goes with it
      (not found, expired, enable, ...), and nothing in them that talks about
      such a notice (a question, a quotation, a narrator, a table row);
    * for blocks of low information that have only a subject: a server gives the
      same response whatever page was asked for. So such a block is flagged where
      it came from several hosts (``source``) and under several address slugs (the
      folder in its path), and where it has nothing to do with the document it
      stands in: none of its longer words is met in the document's title, in the
      rest of its body, or among the terms that lead documents with its slug.

Scale: one pass looks up the parts without which no detector can match, all of them
at once in an automaton; only texts with such a part go on to the patterns, which
judge whole texts. Only blocks with a subject and nothing more are shuffled, by
hash, after counting.

Defined results: null, empty and blank texts are no cases; copies of a document
(same id) come out once; a null path or source only means that the slug or host
evidence is missing; whole texts of any length are used; an empty table gives no
rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.session import cut_lineage

# Notations of template fields.
FIELD = (
    r"(?=[{$#<%@_\[«])(?:\{\{[^{}\n]{1,60}\}\}|\{%[^%\n]{1,60}%\}|[$#]\{[^{}\n]{1,60}\}|<%[^%\n]{1,60}%>|%%\w+%%|@@\w+@@|__[A-Z][A-Z_]*__"
    r"|\$[A-Z][A-Z_]*\$|\[\[[\w. ]{1,40}\]\]|«[a-z]\w*(?:\.\w+)*»|\{[A-Za-z_]\w*(?:\.\w+)*\}|\{\d+\}"
    r"|<(?iu:insert) [^<>\n]{1,60}>|\[(?iu:insert) [^\]\n]{1,60}\]|\[(?iu:to be filled in)[^\]\n]{0,60}\])"
)
# Words of filler text.
LATIN = r"(?:lorem|ipsum|dolor|amet|nibh|velit|ornare|tempor|lectus|culpa|aliqua|magna|porta|nulla|vitae|quis|sit|sed)"
KEYS = r"(?:x{3,}|asdf\w*|qwer\w*|zxcv\w*|hjkl|jkl|tbd|tbc|todo|n/n)"
LATIN_ROW = rf"(?i)(?:\b{LATIN}\b[\s.,;]+){{4}}"
KEY_ROW = rf"(?i)(?:\b{KEYS}\b[\s.,;]+){{1,}}\b{KEYS}\b|(?:^|[\n|])[ \t]*{KEYS}[ \t.]*(?:$|[\n|])"
SAME_ROW = r"\b(?<w>\w++)(?:\s++(?i:\k<w>)\b){4}"
#: parts of which a text has one at least, once it is folded, where the patterns above and below can match; looked up before them
LATIN_PARTS = ("lorem", "ipsum", "dolor", "amet", "nibh", "velit", "ornare", "tempor", "lectus", "culpa", "aliqua", "magna", "porta", "nulla", "vitae", "quis")
LATIN_SHORT = r"s(?:it|ed)[\s.,;]+s(?:it|ed)[\s.,;]"
KEY_PARTS = ("xxx", "asdf", "qwer", "zxcv", "jkl", "tbd", "tbc", "todo", "n/n")
SENTENCE_PARTS = (
    *(f"{a} {b}" for a in ("placeholder", "sample", "dummy", "filler") for b in ("paragraph", "text", "copy")),
    *("text goes here", "blindtext", "texto de relleno", "texto de exemplo", "texte factice", "tekst zastępczy", "текст-заполнитель", "текст-рыба", "örnek metin", "κείμενο δοκιμής", "ダミーテキスト"),
)
FILLER_SENTENCE = (
    r"(?iu)\b(?:placeholder|sample|dummy|filler) (?:paragraph|text|copy)\b[^\n]{0,30}(?:\bgoes here|\breplace|\bto test|–|$)|\btext goes here\b|\bdummy copy\b"
    r"|\bblindtext\b|texto de relleno|texto de exemplo|texte factice|tekst zastępczy|текст-заполнитель|текст-рыба|örnek metin|κείμενο δοκιμής|ダミーテキスト"
)
# What servers, programs and browsers say. A subject alone is weak evidence, and no condition of the other.
SUBJECT = r"(?iu)script|\bjs\b|\bpage\b|página|seite|страниц|strona|sayfa|browser|server|serveur|servidor|сервер|sunucu|service|session|login|signed out|log in|access|acesso|acceso|accès|denied|gateway|forbidden|unauthori|not found|error|exception|fatal|traceback|maintenance|wartung|permission|upstream|retry-after|too many requests|overloaded"
#: for each pattern, the parts of which every text it matches has one at least, once it is folded
NOTICES = (
    # a status line, a page or an object of a status
    (("not found", "forbidden", "unauthori", "bad gateway", "bad request", "gateway time", "service unavailable", "internal server error", "too many requests", "request time", "gone", "not allowed"), r"^\W*(?:http\S* )?[45]\d\d\b\W{0,3}(?:not found|forbidden|unauthori[sz]ed|bad gateway|bad request|gateway time-?out|service unavailable|internal server error|too many requests|request time-?out|gone|method not allowed)\W*$"),
    (("<title>", 'error"', "error'", 'status"', "status'"), r"<title>\s*[45]\d\d\b|[\"']error[\"']\s*:|[\"']status[\"']\s*:\s*[45]\d\d"),
    # a program's own words; frames of a stack are looked up by FRAME
    (("traceback (most", "fatal error:", "warning: undefined", "on line ", "exception: ", "error: "), r"traceback \(most recent call|\bat [\w.$]+\(\w+\.\w+:\d+\)|\bfatal error:|\bwarning: undefined|\bon line \d+\b|\w+(?:exception|error): "),
    # scripts that are needed
    (("script", "js"), r"(?:javascript|\bjs\b|active scripts?|client-side scripts?|scripting|\bscripts?\b).{0,60}(?:enable|activ|ativ|aktiv|switch|turn|allow|requir|must be|needed|not support|blocked|is off|włącz|включ|etkin|ενεργο|有効)"),
    (("script", "js"), r"(?:enable|activ|ativ|aktiv|switch|turn|allow|requir|need|not support|włącz|включ|etkin|ενεργο).{0,60}(?:javascript|\bjs\b|active scripts?|client-side scripts?|scripting|\bscripts?\b)"),
    # pages, sessions and services that aren't there
    (("find the page", "not found", "could not be found", "does not exist", "no longer exists"), r"can.?t find the page|\b(?:page|address|resource|file)\b.{0,30}(?:not found|could not be found|does not exist|no longer exists)"),
    (("página no encontrada", "página não encontrada", "page introuvable", "page non trouvée", "seite nicht gefunden", "страница не найдена", "nie znaleziono strony", "sayfa bulunamadı", "η σελίδα δεν βρέθηκε", "ページが見つかりません"), r"página no encontrada|página não encontrada|page (?:introuvable|non trouvée)|seite nicht gefunden|страница не найдена|nie znaleziono strony|sayfa bulunamadı|η σελίδα δεν βρέθηκε|ページが見つかりません"),
    (("internal server error", "erreur interne", "error interno", "interner ", "внутренняя ошибка", "wewnętrzny błąd", "sunucu hatası"), r"internal server error|erreur interne|error interno|interner (?:server)?fehler|внутренняя ошибка|wewnętrzny błąd|sunucu hatası"),
    (("access denied", "access is denied", "permission denied", "permission is denied", "acesso negado", "acceso denegado", "accès refusé", "zugriff verweigert", "доступ запрещ", "odmowa dostępu", "erişim engellendi", "do not have permission", "may not open this"), r"(?:access|permission) (?:is )?denied|acesso negado|acceso denegado|accès refusé|zugriff verweigert|доступ запрещ|odmowa dostępu|erişim engellendi|do not have permission|may not open this"),
    (("session has e", "been signed out", "login token", "sign in again", "log in and try", "token is no longer valid"), r"session has (?:expired|ended)|been signed out|login token|sign in again|log in and try|token is no longer valid"),
    (("scheduled maintenance", "wartungsarbeiten", "upgrading the server", "service is overloaded", "temporarily unavailable", "upstream system", "did not answer in time", "could not complete your request", "retry-after:", "checking your browser"), r"scheduled maintenance|wartungsarbeiten|upgrading the server|service is overloaded|temporarily unavailable|upstream system|did not answer in time|could not complete your request|retry-after:|checking your browser"),
)
NOTICE = "(?iu)" + "|".join(pattern for _, pattern in NOTICES)
FRAME = r"\(\w+\.\w+:\d+\)"
# Signs that somebody talks about a notice.
TALK = r"(?iu)\?\s*$|[“„«\"]try again|\b(?:interviewer|respondent|programmer|panel|wave|participants?|questionnaire team|moderator|note|noted|notes|said|told|reported|asked|wrote|replied|saw|met an?)\b"
NOTICE_HEAD = r"(?iu)^(?:this questionnaire requires|[<{]|traceback|java\.|warning:|fatal)"


def _has(t: Column, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(t, F.lit(p))
    return out


def _folded(t: Column) -> Column:
    """The text in small letters, as ``(?iu)`` compares them: i with and without its dot, both s, both sigmas are one."""
    t = F.lower(F.replace(t, F.lit("İ"), F.lit("i")))
    for a, b in (("ı", "i"), ("ſ", "s"), ("ς", "σ")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def _parts(parts: Iterable[str]) -> tuple[str, ...]:
    """The parts as they stand in a folded text, without those that contain another."""
    folded = {p.translate(str.maketrans("İıſς", "iisσ")).lower() for p in parts}
    return tuple(sorted(p for p in folded if not any(o in p for o in folded - {p})))


NOTICE_PARTS = _parts(p for parts, _ in NOTICES for p in parts)


SUBJECT_PARTS = _parts("script,js,page,página,seite,страниц,strona,sayfa,browser,server,serveur,servidor,сервер,sunucu,service,session,login,signed out,log in,access,acesso,acceso,accès,denied,gateway,forbidden,unauthori,not found,error,exception,fatal,traceback,maintenance,wartung,permission,upstream,retry-after,too many requests,overloaded".split(","))
FAMILIES = {"latin": _parts(LATIN_PARTS), "keys": _parts(KEY_PARTS), "sentence": _parts(SENTENCE_PARTS), "notice": NOTICE_PARTS, "subject": SUBJECT_PARTS}
_FOLDS = (("İ", "i"), ("ı", "i"), ("ſ", "s"), ("ς", "σ"))


class Scanner:
    """The families of parts that a text has, told in one pass over it."""

    def __init__(self) -> None:
        import ahocorasick

        owners: dict[str, set[str]] = {}
        for family, parts in FAMILIES.items():
            for p in parts:
                owners.setdefault(p, set()).add(family)
        self.find = ahocorasick.Automaton()
        for p, families in owners.items():
            self.find.add_word(p, frozenset(families))
        self.find.make_automaton()
        self.short = re.compile(LATIN_SHORT).search
        self.frame = re.compile(FRAME).search
        self.breaks = re.compile(rf"[\n\r]\s*{MARKS}|\s{{2,}}|[\t\n\x0b\f\r]").sub

    def families(self, text: str) -> set[str]:
        line = self.breaks(" ", text)
        if not line.isascii():
            for a, b in _FOLDS:
                line = line.replace(a, b)
        line = line.lower()
        out: set[str] = set()
        for _, families in self.find.iter(line):
            out |= families
            if len(out) == len(FAMILIES):
                break
        if "latin" not in out and self.short(line):
            out.add("latin")
        if "notice" not in out and self.frame(text):
            out.add("notice")
        return out


def scanned(docs: DataFrame) -> DataFrame:
    """The documents (k, slug, host, t, field, same) with a flag for each family, without those in which nothing can match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner()
        for b in batches:
            found = [scan.families(t) for t in b.column(3).to_pylist()]
            flags = [pa.array([f in x for x in found], pa.bool_()) for f in FAMILIES]
            keep = pa.array([bool(x) or field or same for x, field, same in zip(found, b.column(4).to_pylist(), b.column(5).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([*b.columns, *flags], names=[*b.schema.names, *FAMILIES]).filter(keep)

    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, head + "".join(f", {f} boolean" for f in FAMILIES))


def is_filler(t: Column) -> Column:
    """Of a scanned text."""
    return F.col("same") | (F.col("latin") & t.rlike(LATIN_ROW)) | (F.col("keys") & t.rlike(KEY_ROW)) | (F.col("sentence") & t.rlike(FILLER_SENTENCE))


#: marks of headings, quotes, list entries and stress before a line
MARKS = r"(?:#+|>+|[*-]+)[ \t]*"
# Code lists (rows of several cells, entries that follow each other), the converter's own marks, lines of an interview.
TABLE = r"^\s*\|[^|\n]*[^|\s][^|\n]*\|[^|\n]*[^|\s]|(?m)^[ \t]*[*-][ \t][^\n]*\n[ \t]*[*-][ \t]"
MARK = r"^\s*(?:\\|<!--)"
SPEAKER = r"^[\s#>*-]*+(?!(?i:notice|warning|alert|error|\w*exception):)\p{L}+:"
#: characters of a window on a long block, which begin half of it apart
WINDOW = 600


def _windows(b: Column) -> Column:
    """A block, or the overlapping windows of a long one and its lines, so that all of it is judged."""
    line = F.trim(F.regexp_replace(b, r"\s+", " "))
    at = F.sequence(F.lit(1), F.length(line), F.lit(WINDOW // 2))
    parts = F.concat(F.transform(at, lambda i: F.substring(line, i, F.lit(WINDOW))), F.transform(F.filter(F.split(b, r"\n"), lambda x: F.length(x) <= WINDOW), F.trim))
    return F.when(F.length(line) <= WINDOW, F.array(line)).otherwise(parts)


def blocks(text: Column) -> Column:
    """The paragraphs that could be a notice, of any length, white space collapsed; line ends of all styles.

    Those are no code list, converter's mark or line of an interview; the marks of headings, quotes and entries are taken off.
    """
    raw = F.split(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), r"\n\s*\n")
    kept = F.filter(raw, lambda b: (F.length(b) >= 3) & ~b.rlike(TABLE) & ~b.rlike(MARK) & ~b.rlike(SPEAKER))
    return F.flatten(F.transform(kept, lambda b: _windows(F.regexp_replace(b, r"(?m)^[ \t]*(?:\|[ \t]*|" + MARKS + ")", ""))))


def subject_blocks(text: Column) -> Column:
    """The blocks that have the subject of a notice."""
    return F.filter(blocks(text), lambda b: b.rlike(SUBJECT))


def _notice(b: Column) -> Column:
    return b.rlike(NOTICE) & (~b.rlike(TALK) | b.rlike(NOTICE_HEAD))


def has_notice(text: Column) -> Column:
    """Whether a block of a scanned text reads as a notice."""
    return F.when(F.col("notice"), F.exists(blocks(text), _notice)).otherwise(False)


def slug_terms(df: DataFrame, least_share: float = 0.02) -> DataFrame:
    """(slug, terms): the words that lead at least this share of the documents of a slug.

    At most 1 / ``least_share`` slugs have that share of the corpus and at most
    8 / ``least_share`` words lead that share of a slug, so the table is bounded.
    """
    lead = df.select("slug", F.explode(F.array_distinct("lead")).alias("w"))
    totals = df.groupBy("slug").count().withColumnRenamed("count", "docs")
    return lead.groupBy("slug", "w").count().join(totals, "slug").filter(F.col("count") >= least_share * F.col("docs")).groupBy("slug").agg(F.collect_set("w").alias("terms"))


#: words long enough to say what a text is about
LONG_WORD = r"\p{L}{5,}"


def _long_words(t: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(t), F.lit(LONG_WORD), F.lit(0)))


def find_residue(df: DataFrame, *, key: str = "doc_id", text: str = "text", path: str = "path", host: str = "source", hosts: int = 2, slugs: int = 2, low_words: int = 60) -> DataFrame:
    """(key, field, filler, notice, mismatch): the documents to leave out, with the evidence for each.

    ``hosts`` and ``slugs``: how many of both a block that has only a subject must
    have come from; ``low_words``: words up to which a block is of low information.
    """
    t = F.col("t")
    place = lambda c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    docs = df.select(F.col(key).alias("k"), F.get(F.split(place(path), "/"), F.size(F.split(place(path), "/")) - 2).alias("slug"), place(host).alias("host"), F.col(text).cast("string").alias("t")).filter(F.length(F.trim(t)) > 0)
    found = scanned(docs.select("*", t.rlike(FIELD).alias("field"), t.rlike(SAME_ROW).alias("same")))
    judged = found.select("k", "slug", "host", "t", "subject", "field", is_filler(t).alias("filler"), has_notice(t).alias("notice"))
    direct = F.col("field") | F.col("filler") | F.col("notice")
    evident = cut_lineage(judged.filter(direct | F.col("subject")).withColumn("t", F.when(~direct, t)))
    flagged = evident.filter(direct).select("k", "field", "filler", "notice", F.lit(False).alias("mismatch"))

    # blocks with a subject only: the same response from several hosts and under several slugs, that has nothing to do with its document
    masked = lambda b: F.xxhash64(F.regexp_replace(F.lower(b), r"[0-9a-f]{8,}|\d+", "0"))
    few = lambda b: F.size(F.split(b, r"\s+", low_words + 1)) <= low_words
    weak = evident.filter(~direct).select("k", "slug", "host", "t", F.explode(F.filter(subject_blocks(t), lambda b: few(b) & ~b.rlike(TALK))).alias("b")).withColumn("h", masked(F.col("b")))
    common = weak.groupBy("h").agg(F.countDistinct("host").alias("n_hosts"), F.countDistinct("slug").alias("n_slugs")).filter((F.col("n_hosts") >= hosts) & (F.col("n_slugs") >= slugs)).select("h")
    rest = F.regexp_replace(F.col("t"), r"\s+", " ")
    suspects = weak.join(common, "h").withColumn("body", _long_words(F.replace(rest, F.col("b"), F.lit(" ")))).withColumn("words", _long_words(F.col("b")))
    alone = suspects.filter(~F.arrays_overlap("body", "words"))
    # documents with such a response don't say what their slug is about
    own = weak.join(common, "h").select(F.col("k").alias("held")).distinct()
    leads = docs.filter("slug is not null").join(own, F.col("k").eqNullSafe(F.col("held")), "left_anti").select("slug", F.slice(_long_words(t), 1, 8).alias("lead"))
    terms = slug_terms(leads)
    mismatched = alone.join(terms, "slug", "left").filter(~F.arrays_overlap("words", F.coalesce("terms", F.array().cast("array<string>"))))
    mismatched = mismatched.select("k", *[F.lit(False).alias(c) for c in ("field", "filler", "notice")], F.lit(True).alias("mismatch"))
    out = flagged.unionByName(mismatched).groupBy("k").agg(*[F.max(c).alias(c) for c in ("field", "filler", "notice", "mismatch")])
    return out.withColumnRenamed("k", key)


def without_residue(df: DataFrame, found: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """The corpus without the documents found."""
    return df.join(found.select(key), key, "left_anti")
