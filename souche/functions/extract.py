"""Labels and lists drawn from running text.

Texts are folded (lower case, no accents) before labels are sought, so each label is given by
folded words; the first label of a list that occurs wins.
"""

from __future__ import annotations

import re
from functools import cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from souche.functions import text as T

# Labels and the folded words that name them, in order of precedence.
LANGUAGES = [
    ("vieux haut allemand", "vieux (?:haut )?allemand"), ("vieux français", "vieux francais"), ("hébreu", "hebreu"), ("arabe", "arabe"),
    ("latin", "latin"), ("grec", "grec(?: ancien)?"), ("germanique", "germanique"), ("francique", "francique"), ("celte", "celtique?"),
    ("gaulois", "gaulois"), ("norrois", "norrois"), ("scandinave", "scandinave"), ("sanskrit", "sanskrit"), ("persan", "persan"),
    ("slave", "slave"), ("anglais", "anglais"), ("gaélique", "gaelique"), ("basque", "basque"), ("breton", "breton"), ("gascon", "gascon"),
    ("occitan", "occitan"), ("alsacien", "alsacien"), ("turc", "turque?"), ("polynésien", "polynesien"), ("japonais", "japonais"), ("chinois", "chinois"),
]
SURNAME_LANGUAGES = [
    ("vieux haut allemand", "du vieux (?:haut )?allemand"), ("vieux français", "du vieux francais"), ("latin", "du latin"),
    ("grec", "du grec(?: ancien)?"), ("hébreu", "de l['’ ]hebreu"), ("arabe", "de l['’ ]arabe"), ("germanique", "du germanique"),
    ("francique", "du francique"), ("celte", "du celtique?"), ("gaulois", "du gaulois"), ("norrois", "du norrois"),
    ("scandinave", "du scandinave"), ("sanskrit", "du sanskrit"), ("persan", "du persan"), ("slave", "du slave"),
    ("anglais", "de l['’ ]anglais"), ("gaélique", "du gaelique"), ("basque", "d['’ ]origine basque"), ("breton", "d['’ ]origine bretonne?"),
    ("gascon", "du gascon"), ("occitan", "de l['’ ]occitan"), ("alsacien", "de l['’ ]alsacien"),
]
RELIGIONS = [
    ("chrétien", "sainte?|bible|biblique|apotre|evangile|evangelique|pape|eveque|abbe|christianisme|chretien"),
    ("musulman", "islam|musulman|coran|prophete"), ("juif", "juif|hebreu|torah|synagogue|rabin"), ("païen", "druidique|celtique"),
    ("mythologique", "mythologie"), ("hindou", "hindu|hindouisme"), ("bouddhiste", "bouddhiste?"),
]
_REGIONS = [
    ("pays basque", "pays basque"), ("franche-comté", "franche[- ]comte"), ("bretagne", "bretagne"), ("normandie", "normandie"),
    ("alsace", "alsace"), ("lorraine", "lorraine"), ("provence", "provence"), ("languedoc", "languedoc"), ("gascogne", "gascogne"),
    ("bourgogne", "bourgogne"), ("auvergne", "auvergne"), ("savoie", "savoie"),
]
SURNAME_PLACES = [
    *_REGIONS[:2], ("île-de-france", "ile[- ]de[- ]france"), ("nord-pas-de-calais", "nord[- ]pas[- ]de[- ]calais"), *_REGIONS[2:],
    *((x, T.fold_py(x)) for x in ("dauphiné", "poitou", "anjou", "touraine", "champagne", "picardie", "flandre", "catalogne", "jura", "france")),
    *((x, T.fold_py(x)) for x in ("allemagne", "angleterre", "italie", "espagne", "portugal", "belgique", "suisse")), ("pays-bas", "pays[- ]bas"),
    *((x, T.fold_py(x)) for x in ("scandinavie", "irlande", "pologne", "maghreb", "maroc", "algérie", "tunisie")),
]
PLACES = [
    *_REGIONS, ("jura", "jura"), ("france", "france|francais"), ("allemagne", "allemagne|allemand"), ("angleterre", "angleterre|anglais"),
    ("italie", "italie|italien"), ("espagne", "espagne|espagnol"), ("portugal", "portugal|portugais"), ("belgique", "belgique"), ("suisse", "suisse"),
    ("scandinavie", "scandinavie"), ("irlande", "irlande|irlandais"), ("pologne", "pologne|polonais"), ("maghreb", "maghreb"),
    ("écosse", "ecosse|ecossais"), ("pays-bas", "pays[- ]bas"), ("grèce", "grece|grec"), ("turquie", "turquie|turc"), ("israël", "israel"),
    ("arabie", "arabie"), ("afrique", "afrique|africain"), ("égypte", "egypte|egyptien"), ("france", "hexagone"),
]
BAG_LANGUAGES = "arabe hébreux hébreu latin germanique germain celtique celte breton bretonne gaulois gauloise grec grecque scandinave norse viking anglais occitan provençal flamand alsacien basque catalan espagnol portugais italien slave sémitique berbère normand normande francique mérovingien".split() + ["vieux français", "vieux haut allemand"]
BAG_PLACES = "bretagne normandie alsace lorraine provence languedoc gascogne bourgogne auvergne poitou anjou touraine champagne picardie flandre catalogne france allemagne angleterre italie espagne portugal belgique suisse jura savoie dauphiné midi".split() + ["pays basque", "franche comté", "île de france"]
MULTI_LANGUAGES = {
    "germanique": ["germanique", "germain", "allemand", "frankish"], "français": ["français", "francais"],
    "latin": ["latin", "romano", "gallo-roman"], "breton": ["breton", "celtique", "celte"],
    "occitan": ["occitan", "languedocien", "gascon", "provençal"], "basque": ["basque", "euskara", "euskal"],
    "flamand": ["flamand", "néerland"], "corse": ["corse"], "arabe": ["arabe", "arabo", "arabique"],
    "hébreu": ["hébreu", "hébraïque", "bible"], "alsacien": ["alsacien", "alémanique"], "espagnol": ["espagnol", "castillan", "ibérique"],
    "italien": ["italien"], "polonais": ["polonais"], "anglais": ["anglais", "anglonormand"],
}
PLACE_WORDS = "bretagne normandie alsace lorraine provence occitanie gascogne flandre picardie bourgogne languedoc savoie auvergne vendée anjou touraine poitou berry limousin aquitaine catalogne corse rhône loire seine garonne pyrénée alpes ardenne champagne".split() + ["pays basque"]
VARIANT_LABELS = [r"variantes? ou formes? voisines?", r"formes? voisines? ou variantes?", r"variantes?", r"formes? voisines?", r"formes? apparentees?"]
DERIVED_LABELS = [r"derives? ou formes? derivees?", r"formes? derivees? ou derives?", r"derives?", r"formes? derivees?"]
SECTION_WORDS = r"variante|derive|forme|diminutif|hypocoristique|frequence|etymologie|origine|histoire|note ?:"
GRAMMAR_WORDS = set("des les une un du de la le aux au ses ces mes tes nos vos leur leurs ce cet cette mon ton son par pour sur sous dans avec sans entre qui que quoi dont ou et ni mais puis plus tres aussi ainsi notamment comme indigents indigentes personnes gens autres etc".split())
NOT_NAMES = set("france europe afrique asie egypte rome paris saint sainte dieu bible coran islam christianisme janvier fevrier mars avril mai juin juillet aout septembre octobre novembre decembre lundi mardi mercredi jeudi vendredi samedi dimanche bretagne alsace normandie provence nord sud est ouest".split())
LINK_STOPWORDS = "etant dont qui que les des une son ses par sur est pas plus tout cette dans pour avec comme mais donc car ainsi aussi tres saint sainte saints saintes".split()
ENUMERATION_ORIGINS = "anglaise espagnole italienne allemande latine bretonne occitane catalane portugaise polonaise russe scandinave".split()
ENUMERATION_SIGNALS = ["a donne", "a donne aussi", "a donne egalement", "se decline en", "se decline aussi en", "se decline egalement en", "tel que", "tels que", "telle que", "telles que"]
SIGNALS_BEFORE_CAPITAL = ["comme", "notamment", "entre"]
JOINING_WORDS = ["et", "ou", "and", "or", "puis"]
PARTICLES = ["Da", "De", "Di", "Do", "Du", "Des", "La", "Le", "Las", "Les", "Van", "Von", "Del", "Della", "Af", "O'", "Mac", "Moc", "San", "Son", "Santa", "Sonta"]
# End of the fixed values.

LEFT, RIGHT = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def first_label(col: Column, labels: list[tuple[str, str]]) -> Column:
    """The first label whose words occur whole in the text; '' if none does."""
    def pick(body: Column) -> Column:
        return F.coalesce(*(F.when(body.rlike(f"{LEFT}(?:{words}){RIGHT}"), label) for label, words in labels), F.lit(""))

    return T.bound(T.squeeze(T.fold(col)), pick)


def bag_label(col: Column, labels: list[str]) -> Column:
    """The first label all of whose words are among the text's words."""
    def pick(words: Column) -> Column:
        return F.coalesce(*(F.when(reduce(lambda a, b: a & b, (F.array_contains(words, w) for w in T.words_py(label))), label) for label in labels), F.lit(""))

    return T.bound(T.words(col), pick)


def multi_labels(col: Column, labels: dict[str, list[str]]) -> Column:
    """All labels one of whose keywords occurs anywhere in the lower-cased text."""
    body = F.coalesce(F.lower(col), F.lit(""))
    hits = [F.when(reduce(lambda a, b: a | b, (body.contains(w) for w in words)), F.lit(label)) for label, words in labels.items()]
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def roman_value(col: Column) -> Column:
    """Value of a roman numeral up to 39; NULL if it is none."""
    up = F.upper(col)
    tens = F.length(F.regexp_extract(up, "^(X{0,3})", 1)) * 10
    ones = F.regexp_extract(up, "^X{0,3}(.*)$", 1)
    unit = F.when(ones == "IX", 9).when(ones == "IV", 4).when(ones.startswith("V"), 4 + F.length(ones)).otherwise(F.length(ones))
    return F.when(up.rlike("^(?=.)X{0,3}(IX|IV|V?I{0,3})$"), tens + unit)


def date_struct(col: Column) -> Column:
    """STRUCT<label, valeur>: a century by its middle year, else the first year from 1000 to 2029."""
    body = F.coalesce(T.fold(col), F.lit(""))
    roman = F.upper(F.regexp_extract(body, LEFT + r"([xvi]+)(?:ieme|eme|er|e)?\s*siecle" + RIGHT, 1))
    century = roman_value(roman)
    year = F.regexp_extract(body, LEFT + r"(1[0-9]{3}|20[0-2][0-9])" + RIGHT, 1)
    return (
        F.when(century.isNotNull(), F.struct(F.concat(roman, F.lit(" siècle")).alias("label"), ((century - 1) * 100 + 50).cast("int").alias("valeur")))
        .when(year != "", F.struct(year.alias("label"), year.try_cast("int").alias("valeur")))
        .otherwise(F.struct(F.lit("").alias("label"), F.lit(None).cast("int").alias("valeur")))
    )


def year_of(col: Column) -> Column:
    return F.nullif(F.regexp_extract(col, r"(\d{4})", 1), F.lit("")).try_cast("int")


def sex_of_url(col: Column) -> Column:
    return F.when(col.contains("fille"), "fille").when(col.contains("garcon"), "garcon").otherwise("inconnu")


def labelled_list(col: Column, labels: list[str]) -> Column:
    """Items after the first label that has any: up to the sentence's end or the next label, bracketed remarks dropped."""
    section = rf"(?is)^(.*?)(?:{SECTION_WORDS})"

    def items(tail: Column) -> Column:
        parts = F.transform(F.split(F.regexp_replace(tail, r"\([^)]*\)", ""), "[,;]+"), lambda x: F.trim(x, F.lit(". \t\n")))
        return F.filter(parts, lambda x: (F.length(x) >= 2) & ~x.rlike(r"^\d+$"))

    def cut_at_label(tail: Column) -> Column:
        plain = T.drop_accents(tail)
        return F.when(plain.rlike(rf"(?i){SECTION_WORDS}"), tail.substr(F.lit(1), F.length(F.regexp_extract(plain, section, 1)))).otherwise(tail)

    def search(plain: Column) -> Column:
        ways = []
        for label in labels:
            pattern = rf"(?is)^.*?(?:{label.replace(' ', r'\s+')})\s*:"
            tail = col.substr(F.length(F.regexp_extract(plain, pattern, 0)) + 1, F.length(col))
            tail = F.regexp_replace(tail, r"(?s)\.(?:\s+\p{Lu}.*|\s*)$", "")
            found = T.bound(T.bound(tail, cut_at_label), items)
            ways.append(F.when(plain.rlike(pattern), T.bound(found, lambda x: F.when(F.size(x) > 0, x))))
        return F.coalesce(*ways, F.array().cast("array<string>"))

    return T.bound(T.drop_accents(col), search)  # of the text's length for precomposed letters, so places carry over


def ordered_distinct(arr: Column, key) -> Column:
    """First of each key, order kept."""
    return F.aggregate(
        arr, F.array().cast("array<string>"),
        lambda acc, x: F.when(F.exists(acc, lambda y: key(y) == key(x)), acc).otherwise(F.concat(acc, F.array(x))),
    )


def labelled_names(col: Column, first_name: bool = False) -> Column:
    derived = [*DERIVED_LABELS, "diminutifs?"] if first_name else DERIVED_LABELS
    return ordered_distinct(F.concat(labelled_list(col, VARIANT_LABELS), labelled_list(col, derived)), lambda x: F.lower(x))


def candidates(col: Column, first_name: bool = False) -> Column:
    """Words that may be names: capitalised, in typographic marks, or compound; distinct by folded form."""
    if first_name:
        kinds = [r"(?<![\p{L}\p{N}_-])(\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)+)(?![\p{L}\p{N}_])", r"(?<![\p{L}\p{N}_])(\p{Lu}\p{Ll}{2,})(?![\p{L}\p{N}_])", r"[`*_]([\p{L}-]{2,})[`*_]"]
    else:
        particle = "|".join(PARTICLES)
        kinds = [r"(?<![\p{L}\p{N}_])(\p{Lu}[\p{L}-]+)(?![\p{L}\p{N}_])", r"[`*_\"']([\p{L}-]{2,})[`*_\"']", rf"(?<![\p{{L}}\p{{N}}_])((?:{particle})\s+\p{{Lu}}[\p{{L}}-]+(?:\s+\p{{Lu}}[\p{{L}}-]+)?)(?![\p{{L}}\p{{N}}_])"]
    found = F.concat(*(F.regexp_extract_all(col, F.lit(k), 1) for k in kinds))
    key = T.first_name_key if first_name else T.surname_key

    def pick(words: Column) -> Column:
        def first(ks: Column) -> Column:
            return F.transform(F.filter(F.array_distinct(ks), lambda k: k != ""), lambda k: F.element_at(words, F.array_position(ks, k).cast("int")))

        return F.transform(F.array(F.transform(words, lambda x: key(x))), first)[0]

    # one-element arrays bind the words and their keys, so that each is computed once a text
    return F.transform(F.array(found), pick)[0]


def close_names(name: Column, col: Column, first_name: bool = False) -> Column:
    """Candidates of the text within the edits allowed for the name, itself excluded."""
    key = T.first_name_key if first_name else T.surname_key
    own = key(name)
    limit = T.distance_limit(F.length(own))
    out = F.filter(candidates(col, first_name), lambda c: (key(c) != own) & (F.levenshtein(key(c), own) <= limit))
    if first_name:
        bad = F.array(*(F.lit(w) for w in sorted(NOT_NAMES)))
        out = F.filter(out, lambda c: ~F.array_contains(bad, key(c)))
    return out


_PIECE = re.compile(r"[^\W\d_][\w-]*|\S")


@cache
def _signals() -> dict[str, list[tuple[list[str], bool]]]:
    """First word -> (words that announce a list, whether a capital must follow), the longest first."""
    out: dict[str, list[tuple[list[str], bool]]] = {}
    plain = [(s.split(), False) for s in ENUMERATION_SIGNALS] + [([o + s, ":"], False) for o in ENUMERATION_ORIGINS for s in ("", "s")]
    for words, capital in sorted(plain + [([s], True) for s in SIGNALS_BEFORE_CAPITAL], key=lambda x: -len(x[0])):
        out.setdefault(words[0], []).append((words, capital))
    return out


def enumerated_py(body: str | None) -> list[str]:
    """Names listed after a phrase that announces them: items follow one another while joined by , ; et ou puis.

    The text is cut into words and marks; a list is read from the piece after its signal: an item, then as long as a
    mark or a joining word (or both) stands between, the next. Items have 2 to 20 letters and are no grammar word.
    """
    pieces = _PIECE.findall(body or "")
    folded = [T.fold_py(p) for p in pieces]
    out, seen = [], set()
    for i, word in enumerate(folded):
        for words, capital in _signals().get(word, ()):
            at = i + len(words)
            if folded[i:at] == words and at < len(pieces) and (not capital or pieces[at][0].isupper()):
                break
        else:
            continue
        while at < len(pieces) and pieces[at][0].isalpha() and 2 <= len(pieces[at]) <= 20 and folded[at] not in JOINING_WORDS:
            key = " ".join(folded[at].replace("-", " ").split())
            if key not in GRAMMAR_WORDS and key not in seen:
                seen.add(key)
                out.append(pieces[at])
            after = at + 1
            if after < len(pieces) and pieces[after] in ",;":
                after += 1
            if after < len(pieces) and folded[after] in JOINING_WORDS:
                after += 1
            if after == at + 1:
                break
            at = after
    return out


@F.pandas_udf(ArrayType(StringType()))
def enumerated(col: pd.Series) -> pd.Series:
    return col.map(enumerated_py)


def valid_link(col: Column) -> Column:
    folded = T.fold(col)
    return (F.length(F.trim(col)) >= 2) & col.rlike(r"^[\p{L}\s-]+$") & ~folded.isin(*LINK_STOPWORDS)
