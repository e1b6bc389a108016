"""Line-first quality rules.

Each line with a word is judged by itself, in any language: punctuation (symbols, exclamation or question marks in rows,
or capitals prevail), navigation (rows of separators, menu words, long lists without a function word or sentence end, and
lines within a run of RUN or more neighbouring short lines that end no sentence and aren't list items) and boilerplate
(short lines that are notices of cookies, scripts, rights and the like: a phrase of consent, command or right, or a line that
begins as a notice does; a line that merely has such a word is none). A heading or a lone short line between others stays.
Failing lines are removed; a document that loses more than max_lost of its characters is rejected, as is one that fails
the base rules (too few words, too many words in repeated three-word windows).

Cases: a null or empty text has no words, fails the base rules and keeps "". Repeated rows are judged alike. Lines
without a word pass, and part neighbours. A very long text or line is judged whole, in its row's task. There are no
ties: no row depends on another. An empty table gives an empty result. Other columns are kept, whatever their names (the
operator works on a struct of the row). Per row only: no shuffle. Native: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, bind, words

SYMBOLS = r"[#*$%&|<>]"
SPACE = r"[\x20\x09-\x0D]"
CAPITAL = r"\p{Lu}"
SENTENCE_END = r"[.!?:;…。！？\"'”’»)\]}]\z"
SEPARATORS = r"[|»›•·]"
SHOUT = r"[!?]{2}"
#: What a line must hold to break a rule of symbols, marks, separators or capitals.
ODD = rf"{SYMBOLS}|{SEPARATORS}|{SHOUT}|{CAPITAL}[^\p{{L}}]*{CAPITAL}"
ITEM = r"^(?:[-*+•·–]|[0-9]{1,3}[.)]|[a-zA-Z][.)])[\x20\x09]"
#: What menus and notices of web pages say, in lower case, in English, German, Spanish and French.
MENU = r"^(home|menu|next|previous|login|log in|sign in|sign up|search|share|read more|back to top|skip to content|contact us|startseite|anmelden|suche|weiterlesen|nach oben|kontakt|inicio|iniciar|buscar|compartir|contacto|accueil|connexion|rechercher|partager|lire la suite|haut de page)( |\z|[.,:;!?|>])"
#: Words without which no line is a notice; a line that holds one may be anything yet.
CUES = r"cookie|javascript|rights reserved|rechte vorbehalten|derechos reservados|droits r[ée]serv|lorem ipsum|click here|hier klicken|haga clic|cliquez ici|subscribe|sign up|terms of|privacy policy|nutzungsbedingungen|datenschutz|privacidad|confidentialit"
#: What makes a notice: a site that says so of itself, what the reader is told to do, or the line's first words.
NOTICE = (
    r"(?:^|[^a-z])(?:(?:we|(?:this|our|the) (?:web ?)?(?:site|page|shop)|wir|(?:diese|unsere) (?:web)?seite|este sitio|ce site|nous) (?:[a-z]+ )?(?:uses?|stores?|sets?|nutz(?:t|en)|verwende[nt]|utiliza|utilise|utilisons) (?:[a-z]+ )?cookies"
    r"|(?:accept|allow|manage|reject) (?:all )?cookies|cookies akzeptieren|aceptar cookies|accepter les cookies|cookie (?:policy|settings|preferences|consent|notice)"
    r"|(?:enable|activate|turn on|requires|aktivieren sie|active|activez) javascript|javascript (?:is|must be|needs to be) (?:disabled|enabled|required|turned)|all rights reserved|alle rechte vorbehalten|todos los derechos reservados|tous droits r[ée]serv[ée]s"
    r"|(?:subscribe to|sign up for) (?:our|the) (?:[a-z]+ )?newsletter)(?:[^a-z]|\z)"
    r"|^(?:lorem ipsum|click here|hier klicken|haga clic|cliquez ici|subscribe (?:to|now|today|here)|sign up (?:for|now|today|here)|(?:our |the )?(?:terms of (?:use|service)|privacy policy)|nutzungsbedingungen|datenschutzerkl[äa]rung|pol[ií]tica de privacidad|politique de confidentialit[ée])(?:[^a-z].{0,40})?\z"
)
FUNCTION_WORD = r"(?:^|[\x20\x09])(?:the|of|and|to|in|is|der|die|das|und|den|von|el|la|los|las|de|que|y|le|les|et|des|un|une)(?:[\x20\x09,.]|\z)"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
PROSE_WORDS, MENU_CHARS, NOTICE_CHARS, LIST_WORDS, RUN = 10, 60, 200, 20, 3


def parts(text: Column, cut: str) -> Column:
    """How often the pattern of one match occurs; a split is faster than a count."""
    return F.size(F.split(text, cut, -1)) - 1


def line_facts(line: Column) -> Column:
    """struct<line, fails, short> of a line by itself."""

    def of(x: Column) -> Column:
        def known(f: Column) -> Column:
            def judged(n: Column) -> Column:
                marks, shouts = parts(x, SYMBOLS), parts(x, SHOUT)
                loud = ((marks >= 3) & (2 * marks > n)) | ((shouts >= 3) & (2 * shouts > n)) | (parts(x, SEPARATORS) >= 3)
                loud = F.when(f["odd"], loud | ((n >= 3) & (2 * parts(x, CAPITAL) > F.length(x)))).otherwise(F.lit(False))
                menu = (F.length(x) <= MENU_CHARS) & F.lower(x).rlike(MENU)
                listed = (n >= LIST_WORDS) & ~f["ends"] & ~F.lower(x).rlike(FUNCTION_WORD)
                notice = (F.length(x) <= NOTICE_CHARS) & F.lower(x).rlike(CUES) & F.lower(x).rlike(NOTICE)
                short = (n > 0) & (n < PROSE_WORDS) & ~f["ends"] & ~x.rlike(ITEM)
                return F.struct(line.alias("line"), ((x != "") & (loud | menu | listed | notice)).alias("fails"), short.alias("short"))

            # words are counted only where the rules below ask for them
            return bind(F.when(f["odd"] | ~f["ends"], F.size(words(x))).otherwise(0), judged)

        return bind(F.struct(x.rlike(ODD).alias("odd"), x.rlike(SENTENCE_END).alias("ends")), known)

    return bind(F.trim(line, F.lit(SPACES)), of)


def in_short_run(lines: Column, k: Column) -> Column:
    """Whether RUN neighbouring lines, that at k among them, are short."""
    short = lambda d: (k + d >= 0) & F.coalesce(F.get(lines, k + d)["short"], F.lit(False))
    some = F.lit(False)
    for first in range(1 - RUN, 1):
        every = F.lit(True)
        for d in range(first, first + RUN):
            every = every & short(d)
        some = some | every
    return some


def cleaned_text(text: Column) -> Column:
    def kept(facts: Column) -> Column:
        alone = F.filter(facts, lambda x: ~x["fails"])
        rows = F.filter(facts, lambda x, k: ~(x["fails"] | (x["short"] & in_short_run(facts, k))))
        few = F.size(F.filter(facts, lambda x: x["short"])) < RUN
        return F.transform(F.when(few, alone).otherwise(rows), lambda x: x["line"])

    return F.array_join(bind(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), line_facts), kept), "\n")


def repeated_window_words(own: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more in the array."""
    window = lambda w: lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def counted(h: Column) -> Column:
        order = F.sort_array(F.transform(h, lambda x, k: F.struct(x.alias("h"), k.alias("i"))))
        twice = lambda s: F.transform(F.filter(s, lambda x, k: (F.get(s, k + 1)["h"] == x["h"]) | ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))), lambda x: x["i"])
        cover = lambda at: F.aggregate(F.transform(at, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - i, F.lit(3)))), F.lit(0), lambda a, b: a + b)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(bind(F.sort_array(bind(order, twice)), cover))

    return bind(own, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(bind(F.transform(F.sequence(F.lit(0), F.size(w) - 3), window(w)), counted))).cast("long")


def judged(docs: DataFrame, text_col: str = "text", max_lost: float = 0.5) -> DataFrame:
    """(row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, kept_text, base_failed, kept); row: the row of
    docs as a struct."""
    text = F.coalesce(docs[text_col], F.lit(""))
    out = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), text.alias("text"))
    out = out.withColumn("words", words(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda line: F.trim(line, F.lit(SPACES)) != "")
    out = out.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - parts(F.col("text"), SPACE)).cast("long").alias("word_chars"),
        parts(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        bind(lines, lambda own: F.size(own) - F.size(F.array_distinct(own))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("words")).alias("n_repeat_words"),
        cleaned_text(F.col("text")).alias("kept_text"),
        F.length("text").alias("n_text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    lost = F.col("n_text") - F.length("kept_text")
    return out.withColumn("kept", ~F.col("base_failed") & (lost <= max_lost * F.col("n_text"))).drop("n_text")


def keep_good(docs: DataFrame, text_col: str = "text", max_lost: float = 0.5) -> DataFrame:
    """The columns of docs for the documents that pass, with the text that their good lines leave."""
    out = judged(docs, text_col, max_lost).where("kept")
    return out.select(*[F.col("kept_text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
