"""Personal data replaced by surrogates.

One pattern finds the entities of a text.  An entity is broken into parts
(a name into given name and surname, all else is one part), and equal parts in
canonical form get equal surrogates everywhere, whatever their case or
separators, so coreference survives.  A surrogate is drawn from a keyed hash
and has the part's type, length, case, script, gender and checksum.  Draws that
meet another part's surrogate, or a part that really occurs, are drawn again,
so distinct parts stay distinct and no surrogate is somebody else's data.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import let, stage

# --- fixed values: patterns and lists ----------------------------------------
_A = r"\p{L}\p{N}"
MALE = "Mr|Herr|Monsieur|Señor|Sr|Господин"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Госпожа"
PATTERNS = {  # in order of preference at one place
    "email": rf"(?<![{_A}._%+\-])[{_A}._%+\-]{{1,64}}+@(?:[{_A}\-]{{1,63}}\.)+\p{{L}}{{2,24}}",
    "secret": rf"(?<![{_A}])(?:[0-9a-f]{{32,128}}|[0-9A-F]{{32,128}}|AKIA[0-9A-Z]{{16}}|ghp_[0-9A-Za-z]{{36}}|sk-[0-9A-Za-z]{{20,64}})(?![{_A}])",
    "ip": rf"(?<![{_A}.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){{3}}(?![{_A}]|\.\d)",
    "iban": rf"(?<![{_A}])[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?(?![{_A}])",
    "ssn": rf"(?<![{_A}\-])\d{{3}}-\d{{2}}-\d{{4}}(?![{_A}\-])",
    "card": rf"(?<![{_A}.+\-])\d(?:[ \-]?\d){{12,18}}(?![{_A}])",
    "phone": rf"(?<![{_A}])(?:\+\d{{1,3}}[ .\-]?)?(?:\(\d{{2,4}}\)[ .\-]?|\d{{2,4}}[ .\-])\d{{3,4}}[ .\-]\d{{3,4}}(?![{_A}])",
    "name": rf"(?<![{_A}])(?:{MALE}|{FEMALE}|Dr)\.? \p{{Lu}}\p{{Ll}}+(?:[ \-]\p{{Lu}}\p{{Ll}}+)?",
}
GIVEN = {
    ("m", "latin"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Kurt Leo Martin Nils Oscar Paul Rafael Simon Tom Victor",
    ("f", "latin"): "Alma Berta Clara Diana Emma Flora Greta Helena Ida Julia Karla Lena Maria Nora Olga Paula Rosa Sara Tina Vera",
    ("n", "latin"): "Alex Andrea Billie Charlie Dana Eli Frankie Gabriel Harper Jamie Kim Luca Morgan Nikita Robin Sam Sascha Toni Val Yuri",
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Захар Игорь Кирилл Лев Максим Никита Олег Павел Роман",
    ("f", "cyrillic"): "Алла Белла Вера Галина Дарья Ева Зоя Инна Кира Лидия Марина Нина Ольга Полина Рита",
    ("n", "cyrillic"): "Саша Женя Валя Слава Шура",
}
SYLLABLES = {
    "latin": "ba bel cor dan del fen gar hal jor kal lan mar mon nor pel ran ros sel tor van wel zan",
    "cyrillic": "ба вер гор дан жел зор кал лан мар нов пел рос сел тор фен хан",
}
# -----------------------------------------------------------------------------
ENTITY = "|".join(PATTERNS.values())
ROUNDS_BEFORE_GROWTH = 8  # then a surrogate gets a character more every so many rounds


def _full(pattern: str) -> str:
    """The pattern for a whole string that was found by it."""
    return f"^(?:{pattern})$"


def entity_type(raw: Column) -> Column:
    kind = F.when(raw.rlike(_full(PATTERNS["email"])), "email")
    for name in [*PATTERNS][1:]:
        kind = kind.when(raw.rlike(_full(PATTERNS[name])), name)
    return kind


def _parts(raw: Column, kind: Column) -> Column:
    """Array of (type, canonical form, text) of an entity; a NULL type is kept text."""
    part = lambda t, canon, text: F.struct(t.alias("type"), canon.alias("canon"), text.alias("text"))
    title = F.regexp_extract(raw, r"^(\p{L}+)\.? ", 1)
    gender = F.when(title.rlike(f"^(?:{MALE})$"), "m").when(title.rlike(f"^(?:{FEMALE})$"), "f").otherwise("n")
    script = F.when(raw.rlike(r"\p{IsCyrillic}\p{Ll}*$"), "cyrillic").otherwise("latin")
    lead = F.regexp_extract(raw, r"^\p{L}+\.? ", 0)
    given = F.regexp_extract(raw, r"^\p{L}+\.? (\p{L}+)[ \-]", 1)
    joint = F.regexp_extract(raw, r"^\p{L}+\.? \p{L}+([ \-])", 1)
    last = F.regexp_extract(raw, r"(\p{L}+)$", 1)
    keep = lambda text: part(F.lit(None).cast("string"), F.lit(None).cast("string"), text)
    name = F.filter(F.array(
        keep(lead), part(F.concat(F.lit("given-"), gender, F.lit("-"), script), F.lower(given), given), keep(joint),
        part(F.concat(F.lit("surname-"), script), F.lower(last), last)), lambda p: p["text"] != "")
    digits = F.regexp_replace(raw, r"\D", "")
    canon = (F.when(kind.isin("card", "phone", "ssn"), digits).when(kind == "iban", F.replace(raw, F.lit(" "), F.lit("")))
             .when(kind.isin("secret", "ip"), raw).otherwise(F.lower(raw)))
    return F.when(kind == "name", name).otherwise(F.array(part(kind, canon, raw)))


def _noise(key: str, seed: Column) -> Column:
    """384 hexadecimal digits of a keyed hash; two give a number below 256."""
    return F.concat(*[F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(str(k)), seed), 256) for k in range(6)])


def _number(noise: Column, k: Column) -> Column:
    """The k-th number (from 0) of the noise, below 65,536."""
    return F.conv(F.substr(noise, (k % 96) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _drawn(text: Column, noise: Column) -> Column:
    """Letters and digits replaced by others of their kind; all else stays."""
    pick = lambda alphabet, k: F.substr(F.lit(alphabet), _number(noise, k) % len(alphabet) + 1, F.lit(1))
    low, cyr = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя"

    def one(c: Column, k: Column) -> Column:
        return (F.when(c.rlike(r"\p{Nd}"), pick("0123456789", k)).when(c.rlike(r"\p{IsCyrillic}"), F.when(c.rlike(r"\p{Lu}"), F.upper(pick(cyr, k))).otherwise(pick(cyr, k)))
                .when(c.rlike(r"\p{Lu}"), F.upper(pick(low, k))).when(c.rlike(r"\p{L}"), pick(low, k)).otherwise(c))

    return F.array_join(F.transform(_chars(text), one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10."""
    n = F.length(digits)

    def add(c: Column, k: Column) -> Column:
        d = c.cast("int")
        return F.when((n - k) % 2 == 0, F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.transform(_chars(digits), add), F.lit(0), lambda a, d: a + d) % 10


def _card(canon: Column, noise: Column) -> Column:
    """Digits with the Luhn remainder of the original."""
    body = F.concat(_drawn(F.substr(canon, F.lit(1), F.length(canon) - 1), noise), F.lit("0"))
    check = F.pmod(_luhn(canon) - _luhn(body), F.lit(10))
    return F.concat(F.substr(body, F.lit(1), F.length(body) - 1), check.cast("string"))


def _iban(canon: Column, noise: Column) -> Column:
    """Country kept, account drawn, check digits right for it."""
    land, account = F.substr(canon, F.lit(1), F.lit(2)), _drawn(F.substr(canon, F.lit(5), F.length(canon)), noise)

    def step(a: Column, c: Column) -> Column:
        v = F.conv(c, 36, 10).cast("int")
        return (F.when(v > 9, a * 100 + v).otherwise(a * 10 + v)) % 97

    rest = F.aggregate(_chars(F.concat(account, land, F.lit("00"))), F.lit(0), step)
    return F.concat(land, F.lpad((98 - rest).cast("string"), 2, "0"), account)


def _ip(canon: Column, noise: Column) -> Column:
    """Private and loopback networks are kept, all else is drawn."""
    keep = (F.when(canon.rlike(r"^(10|127)\."), 1).when(canon.rlike(r"^(192\.168|172\.(1[6-9]|2\d|3[01]))\."), 2).otherwise(0))
    octet = lambda o, k: F.when(k < keep, o).otherwise(F.when(k == 0, _number(noise, k) % 223 + 1).otherwise(_number(noise, k) % 256).cast("string"))
    return F.array_join(F.transform(F.split(canon, r"\."), octet), ".")


def _listed(words: str, noise: Column) -> Column:
    options = words.split()
    return F.element_at(F.array(*map(F.lit, options)), _number(noise, F.lit(0)) % len(options) + 1)


def draw(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """A surrogate in canonical form."""
    def drawn(noise: Column) -> Column:
        # A phone keeps its first digit, a secret its known beginning.
        phone = F.concat(F.substr(canon, F.lit(1), F.lit(1)), _drawn(F.substr(canon, F.lit(2), F.length(canon)), noise))
        hexa = F.array_join(F.transform(_chars(canon), lambda c, k: F.substr(F.lit("0123456789abcdef"), _number(noise, k) % 16 + 1, F.lit(1))), "")
        hexa = F.when(canon.rlike("[A-F]"), F.upper(hexa)).otherwise(hexa)
        head = F.regexp_extract(canon, "^(AKIA|ghp_|sk-)", 0)
        secret = F.when(head == "", hexa).otherwise(F.concat(head, _drawn(F.substr(canon, F.length(head) + 1, F.length(canon)), noise)))
        end = F.regexp_extract(canon, r"\.\p{L}+$", 0)
        email = F.concat(_drawn(F.substr(canon, F.lit(1), F.length(canon) - F.length(end)), noise), end)
        out = (F.when(kind == "email", email).when(kind == "secret", secret).when(kind == "ip", _ip(canon, noise))
               .when(kind == "iban", _iban(canon, noise)).when(kind == "card", _card(canon, noise)).when(kind == "phone", phone)
               .when(kind == "ssn", _drawn(canon, noise)))
        for (gender, script), words in GIVEN.items():
            syllable = _listed(SYLLABLES[script], F.reverse(noise))
            more = F.when(attempt > 0, F.concat(F.lower(syllable), F.when(attempt > 1, F.lower(_listed(SYLLABLES[script], F.substr(noise, F.lit(9), F.length(noise))))).otherwise("")))
            out = out.when(kind == f"given-{gender}-{script}", F.lower(F.concat(_listed(words, noise), F.coalesce(more, F.lit("")))))
        for script, syllables in SYLLABLES.items():
            part = lambda k: _listed(syllables, F.substr(noise, F.lit(1 + 8 * k), F.length(noise)))  # noqa: B023, E731
            out = out.when(kind == f"surname-{script}", F.concat(part(0), part(1), part(2)))
        grown = F.call_function("div", attempt, F.lit(ROUNDS_BEFORE_GROWTH)).cast("int")
        tail = F.substr(F.lit("0123456789"), _number(noise, F.lit(90)) % 10 + 1, F.lit(1))
        letter = F.substr(F.lit("abcdefghij"), _number(noise, F.lit(91)) % 10 + 1, F.lit(1))
        more = F.repeat(F.when(kind.isin("card", "phone", "ssn"), tail).when(kind.startswith("given") | kind.startswith("surname"), letter).otherwise(""), grown)
        return F.concat(out, F.coalesce(more, F.lit("")))

    return let(_noise(key, F.concat_ws("\x1f", kind, canon, attempt.cast("string"))), drawn)


def assign(parts: DataFrame, key: str) -> DataFrame:
    """type, canon, surrogate for distinct ``parts`` (type, canon), one to one per
    type and apart from every canonical form that occurs."""
    real = stage(parts, "pii-parts")
    todo, done, attempt = real, None, 0
    while True:
        drawn = stage(todo.withColumn("surrogate", draw(F.col("type"), F.col("canon"), F.lit(attempt), key)), "pii-draw")
        free = drawn.join(real.select("type", F.col("canon").alias("surrogate")), ["type", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("type", "surrogate"), ["type", "surrogate"], "left_anti")
        first = Window.partitionBy("type", "surrogate").orderBy("canon")
        free = free.withColumn("k", F.row_number().over(first)).filter("k = 1").select("type", "canon", "surrogate")
        done = stage(free if done is None else done.unionByName(free), "pii-done")
        todo = stage(real.join(done, ["type", "canon"], "left_anti"), "pii-todo")
        if todo.isEmpty():
            return done
        attempt += 1


def _poured(text: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the dress of ``text``: its separators and its case."""
    def dressed(chars: Column) -> Column:
        fed = lambda c: c.rlike(r"\d")
        if_spaced = F.transform(chars, lambda c, k: F.when(fed(c), F.substr(surrogate, F.size(F.filter(F.slice(chars, F.lit(1), k + 1), fed)), F.lit(1))).otherwise(c))
        rest = F.substr(surrogate, F.length(F.regexp_replace(text, r"\D", "")) + 1, F.length(surrogate))
        return F.concat(F.array_join(if_spaced, ""), rest)

    def cased(chars: Column) -> Column:
        return F.array_join(F.transform(_chars(surrogate), lambda c, k: F.when(F.coalesce(F.get(chars, k).rlike(r"\p{Lu}"), F.lit(False)), F.upper(c)).otherwise(c)), "")

    def grouped(chars: Column) -> Column:
        fed = lambda c: c != " "
        return F.array_join(F.transform(chars, lambda c, k: F.when(fed(c), F.substr(surrogate, F.size(F.filter(F.slice(chars, F.lit(1), k + 1), fed)), F.lit(1))).otherwise(c)), "")

    chars = _chars(text)
    return (F.when(kind.isNull(), text).when(kind.isin("card", "phone", "ssn"), let(chars, dressed)).when(kind == "iban", let(chars, grouped))
            .when(kind.isin("secret", "ip"), surrogate).otherwise(let(chars, cased)))


def replace_entities(docs: DataFrame, key: str = "surrogates") -> DataFrame:
    """``docs`` with surrogates in ``text``, plus ``n_entities`` and
    ``entity_types`` (of the entities in the text, in order).

    The same key gives the same surrogates in every run over the same table.
    NULL text stays NULL, a text without entities stays as it is; repeated rows
    are replaced alike.  Columns of ``docs`` with those names are replaced; an
    empty table gives no rows.
    """
    out = ("n_entities", "entity_types")
    docs = docs.drop(*out)
    found = lambda: F.regexp_extract_all("text", F.lit(f"({ENTITY})"), F.lit(0))
    has = F.coalesce(F.col("text").rlike(ENTITY), F.lit(False))
    # Only texts with entities are moved.
    hits = stage(docs.filter(has).withColumn("__found", found()).withColumn("__id", F.xxhash64("text")).withColumn("__id2", F.crc32(F.col("text").cast("binary"))), "pii-hits")
    raw = hits.select("__id", "__id2", F.explode(F.array_distinct("__found")).alias("raw")).distinct()
    kinds = raw.select("raw").distinct().withColumn("kind", F.coalesce(entity_type(F.col("raw")), F.lit("other")))
    parts = stage(kinds.select("raw", "kind", F.posexplode(_parts(F.col("raw"), F.col("kind"))).alias("pos", "p")).select("raw", "kind", "pos", "p.*"), "pii-entities")
    given = assign(parts.filter(F.col("type").isNotNull()).select("type", "canon").distinct(), key)
    said = parts.join(given, ["type", "canon"], "left").withColumn("said", _poured(F.col("text"), F.col("type"), F.col("surrogate")))
    said = said.groupBy("raw", "kind").agg(F.sort_array(F.collect_list(F.struct("pos", "said"))).alias("s"))
    said = said.select("raw", "kind", F.array_join(F.transform("s", lambda x: x["said"]), "").alias("said"))
    told = raw.join(said, "raw").groupBy("__id", "__id2").agg(F.collect_list(F.struct("raw", F.struct("said", "kind"))).alias("__told"))
    rows = hits.join(told, ["__id", "__id2"], "left").withColumn("__map", F.map_from_entries("__told"))
    apart = F.split("text", ENTITY)

    def rebuilt(between: Column) -> Column:
        return F.array_join(F.transform(between, lambda t, k: F.concat(t, F.coalesce(F.get(F.col("__words"), k), F.lit("")))), "")

    rows = rows.withColumn("__words", F.transform("__found", lambda r: F.col("__map")[r]["said"]))
    rows = rows.withColumn("__kinds", F.transform("__found", lambda r: F.col("__map")[r]["kind"]))
    same = [F.col(c) for c in docs.columns if c != "text"]
    changed = rows.select(*same, let(apart, rebuilt).alias("text"), F.size("__found").cast("bigint").alias("n_entities"), F.col("__kinds").alias("entity_types"))
    clean = docs.filter(~has).select(*same, "text", F.lit(0).cast("bigint").alias("n_entities"), F.array().cast("array<string>").alias("entity_types"))
    return clean.unionByName(changed).select(*docs.columns, *out)
