"""Replaces personal data and secrets by keyed surrogates, with DataFrame functions only.

Entities are found by patterns, reduced to what identifies them (digits, lower case, the words of a
name) and given a surrogate of the same type: the same length and character classes, valid octets, the
card's issuer digit and check digit, a name of the same gender and script. The surrogate depends on the
key and the entity alone, so every mention of an entity, in whatever spelling or document, gets the same
one. A collision check over all entities gives colliding ones another draw: two entities never share a
surrogate, and no surrogate is an entity of the corpus.

Names are found by the forms of address before them. The gender of a given name is settled per document: a
gendered form of address counts for all mentions of that given name under a neutral one, unless the
document has it under both. Further mentions of a name's words in the same document, capitalised and
without any form of address, are replaced too (words of three letters and more).

Every text is searched once, and work per text and entity grows with its length, also for values of
megabytes. Rows that share everything are replaced alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.llm.common import written

KEY = "surrogates-1"
#: From this draw on a surrogate may leave the format of its entity, so that draws never run out.
STRICT_DRAWS = 6

# Forms of address, by the gender of the person.
MALE = "Mr|Herr|Señor|Monsieur|Господин"
FEMALE = "Mrs|Ms|Miss|Frau|Señora|Madame|Mme|Госпожа"
NEUTRAL = "Dr|Prof"

# Syllables of surrogate names.
LATIN = "ba be bi bo da de di do fa fe ga go ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro".split()
CYRILLIC = "ба бе би бо да де ди до фа фе га го ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро".split()

# Every pattern begins with what fails at most places of a text, as all of them are tried everywhere.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,128}+@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}"
# Name, separator and opening quote of a secret; Java needs the length of what it looks back at to be bounded.
NAMED = r"(?i:password|passwd|pwd|secret|token|api_key)[\"']?[ \t]{0,3}(?:=>|:=|[=:])[ \t]{0,3}"
SECRET = (
    r"(?<=[=:> \t\"'])(?<=[=:>][ \t]{0,3}[\"']?)(?=[^\s\"'])"
    rf"(?:(?<={NAMED}\")[^\"\r\n]{{6,}}+(?=\")|(?<={NAMED}')[^'\r\n]{{6,}}+(?=')|(?<={NAMED}[\"']?)[^\s\"']{{6,}}+)"
    r"|(?=[0-9A-Fa-f])(?<![\p{L}\p{N}])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|AKIA[0-9A-Z]{16})(?![\p{L}\p{N}])"
)
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
ADDRESS = rf"(?=\d)(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?![\w]|\.\d)"
# What stands between the groups of a phone number: a blank, or marks that noise puts after every word.
MARK = r"[^\p{L}\p{N}(+\r\n]{0,4}"
PHONE = (
    rf"(?=[+1(])(?<![\w+.])(?:\+?1{MARK})?\(\d{{3}}\){MARK}\d{{3}}[ .-]\d{{4}}(?![\w-])"
    rf"|(?=[+\d])(?<![\w+.-])(?:\+?1[ .-])?\d{{3}}[ .-]\d{{3}}[ .-]\d{{4}}(?![\w-])"
    # Any country: a plus and 8 to 15 digits, with up to two separators between them.
    r"|(?=\+)(?<![\w+.-])\+[1-9](?:[ ./()-]{0,2}\d){7,14}(?![\w-])"
)
NATIONAL = r"(?=\d)(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = r"(?=\d)(?<![\w.-])(?:\d{16}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|3[47]\d{13})(?![\w-])"
# One or several forms of address, then all capitalised words, initials and particles that follow.
TITLES = rf"(?:(?:{MALE}|{FEMALE}|{NEUTRAL})\.? )"
WORD = r"\p{Lu}(?:['’]\p{Lu})?\p{L}{1,40}+(?:['’]\p{Lu}\p{L}{0,40}+)?"
WORDS = rf"{WORD}(?:-{WORD})*+"
PARTICLES = "(?:(?:von|van|vom|zu|zum|der|den|de|del|della|di|da|dos|du|la|le|y) ){0,3}"
PERSON = rf"(?=\p{{Lu}})(?<!\p{{L}}){TITLES}++(?:\p{{Lu}}\. ){{0,3}}{PARTICLES}{WORDS}(?:(?: \p{{Lu}}\.)*+ {PARTICLES}{WORDS})*+"
NUMBERS = rf"(?=[+(\d])(?:{ADDRESS}|{PHONE}|{NATIONAL}|{CARD})"
PATTERN = "|".join((EMAIL, SECRET, NUMBERS, PERSON))


def _sql(text: str) -> str:
    return "r'" + text.replace("'", "\\x27") + "'"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _parts() -> str:
    """What identifies the entities of a ``surface``, as an array of (kind, canon, gender)."""
    digits = r"regexp_replace(surface, r'\D', '')"
    one = "array(named_struct('kind', {}, 'canon', {}, 'gender', ''))".format
    male, female = (f"surface rlike {_sql(rf'^{TITLES}*(?:{x})\.? ')}" for x in (MALE, FEMALE))
    words = f"split(lower(regexp_replace(surface, {_sql(f'^{TITLES}+')}, '')), '[ -]')"
    gender = f"case when {male} then 'm' when {female} then 'f' else '' end"
    named = _let("ws", words, "transform(ws, (w, i) -> named_struct('kind', if(i = size(ws) - 1, 'surname', 'given'), 'canon', w, 'gender', g))")
    return rf"""case
        when surface rlike {_sql("^" + PERSON + "$")} then {_let("g", gender, named)}
        when surface rlike {_sql("^" + EMAIL + "$")} then {one("'email'", "lower(surface)")}
        when surface rlike {_sql("^" + ADDRESS + "$")} then {one("'address'", "surface")}
        when surface rlike '^(?:[0-9a-f]{{32,}}|[0-9A-F]{{32,}})$' then {one("'hex'", "lower(surface)")}
        when surface rlike '^AKIA' then {one("'access'", "lower(surface)")}
        when surface rlike {_sql("^" + NATIONAL + "$")} then {one("'national'", digits)}
        when surface rlike {_sql("^(?:" + CARD + ")$")} then {one("'card'", digits)}
        when surface rlike {_sql("^(?:" + PHONE + ")$")} then case
            when surface like '+%' and {digits} not rlike r'^1\d{{10}}$' then {one("'abroad'", digits)}
            else {one("'phone'", f"right({digits}, 10)")} end
        else {one("'secret'", "surface")} end"""


def _stream(of: str, n: str, draw: bool = True) -> str:
    """Keyed hexadecimal digits for ``n`` characters of the value ``of``: an array of 64 digits each."""
    seed = f"sha2(concat_ws('\\u0001', surrogate_key, kind, {of}{', draw' if draw else ''}), 256)"
    return _let("seed", seed, f"transform(sequence(0, {n} div 32), k -> sha2(concat(seed, '#', k), 256))")


def _byte(stream: str, i: str) -> str:
    """The byte number ``i`` (from 0) of a stream."""
    return f"cast(conv(substr({stream}[cast(({i}) div 32 as int)], 2 * (({i}) % 32) + 1, 2), 16, 10) as int)"


def _spread(canon: str, stream: str) -> str:
    """Every letter and digit of ``canon`` replaced by one of its class, the rest kept."""
    b = _byte("st", "i")
    spread = f"""array_join(transform(split({canon}, ''), (ch, i) -> case
        when ch rlike '[0-9]' then cast({b} % 10 as string)
        when kind = 'hex' then substr('abcdef', {b} % 6 + 1, 1)
        when ch rlike r'\\p{{IsCyrillic}}' then substr('абвгдежзиклмнопрстуфхцчшэюя', {b} % 27 + 1, 1)
        when ch rlike r'\\p{{Lu}}' then substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', {b} % 26 + 1, 1)
        when ch rlike r'\\p{{L}}' then substr('abcdefghijklmnopqrstuvwxyz', {b} % 26 + 1, 1)
        else ch end), '')"""
    return _let("st", stream, spread)


def _luhn(number: str) -> str:
    """The sum that is a multiple of ten for a valid card number."""
    d = f"cast(substr({number}, length({number}) - i, 1) as int)"
    return (
        f"aggregate(transform(sequence(0, length({number}) - 1), i -> case when i % 2 = 0 then {d} "
        f"else 2 * {d} - 9 * cast({d} > 4 as int) end), 0, (s, x) -> s + x)"
    )


def _name() -> str:
    """A name of two or three syllables and an ending that follows the gender, in the script of ``canon``."""
    cyrillic = r"canon rlike r'\p{IsCyrillic}'"
    listed = lambda syllables: "array(" + ", ".join(f"'{s}'" for s in syllables) + ")"
    take = lambda i: f"element_at(sy, {_byte('stream', str(i))} % size(sy) + 1)"
    more = f"case when {_byte('stream', '8')} % 2 = 0 then {take(2)} else '' end"
    end = f"case kind when 'given_f' then if({cyrillic}, 'на', 'na') when 'given_m' then if({cyrillic}, 'н', 'n') else '' end"
    return _let("sy", f"if({cyrillic}, {listed(CYRILLIC)}, {listed(LATIN)})", f"concat({take(0)}, {take(1)}, {more}, {take(3)}, {end})")


NAMES = "('surname', 'given', 'given_m', 'given_f')"


def _draw(entities: DataFrame, key: str) -> DataFrame:
    """``surrogate`` for every (kind, canon, draw)."""
    domain = "substring_index(canon, '@', -1)"
    host = f"regexp_replace({domain}, r'\\.[^.]+$', '')"
    top = f"concat('.', substring_index({domain}, '.', -1))"
    octet = f"""case when draw >= {STRICT_DRAWS} then {_byte("stream", "i")} % 256
        when length(o) = 1 then {_byte("stream", "i")} % 10
        when length(o) = 2 then 10 + {_byte("stream", "i")} % 90 else 100 + {_byte("stream", "i")} % 156 end"""
    whole = _stream("canon", "length(canon)")
    drawn = entities.withColumn("surrogate_key", F.lit(key)).withColumn("stream", F.expr(_stream("canon", "12")))
    drawn = drawn.withColumn("spread", F.expr(f"case when kind not in {NAMES} and kind != 'address' then {_spread('canon', whole)} end"))
    body = "concat(left(canon, 1), substr(spread, 2, length(canon) - 2))"
    check = f"cast((10 - {_luhn("concat(body, '0')")} % 10) % 10 as string)"
    drawn = drawn.withColumn("body", F.expr(f"case when kind = 'card' then {body} end"))
    spread_domain = _spread(host, _stream(f"concat('@', {domain})", f"length({domain})", draw=False))
    made = f"""case
        when kind in {NAMES} then {_name()}
        when kind = 'email' then concat(left(spread, length(canon) - length({domain}) - 1), '@', {spread_domain}, {top})
        when kind = 'address' then array_join(transform(split(canon, r'\\.'), (o, i) -> cast({octet} as string)), '.')
        when kind = 'access' then concat('akia', substr(spread, 5))
        when kind = 'phone' then concat(2 + {_byte("stream", "0")} % 8, substr(spread, 2))
        when kind = 'abroad' then concat(left(canon, 2), substr(spread, 3))
        when kind = 'card' then concat(body, case when {_luhn("canon")} % 10 = 0 then {check} else right(spread, 1) end)
        else spread end"""
    # Later draws are longer (addresses use all octets), so that there is always a free one.
    more = f"left(sha2(concat_ws('#', stream), 256), draw - {STRICT_DRAWS} + 1)"
    longer = f"""case when draw < {STRICT_DRAWS} or kind = 'address' then surrogate
        when kind = 'email' then concat(left(sha2(concat_ws('#', stream), 256), draw), surrogate)
        when kind in {NAMES} then concat(surrogate, translate({more}, '0123456789', 'ghijklmnop'))
        else concat(surrogate, translate({more}, 'abcdef', '012345')) end"""
    return drawn.withColumn("surrogate", F.expr(made)).withColumn("surrogate", F.expr(longer)).select(
        "kind", "canon", "draw", "surrogate"
    )


#: Entities that a task draws surrogates for, about.
DRAWN_AT_ONCE = 2000


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, canon, surrogate`` for distinct ``entities (kind, canon)``: one to one within a kind.

    Of entities that draw the same surrogate the smallest keeps it; it, and those whose draw is an
    entity itself or taken before, draw again. Rounds go on until all have one.
    """
    pending, done = entities.withColumn("draw", F.lit(0)), None
    while True:
        # A draw takes long for the bytes of its row, so it isn't left to the size of the table.
        pending = pending.repartition(1 + pending.count() // DRAWN_AT_ONCE)
        drawn = written(_draw(pending, key), "drawn")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon"))
        real = entities.select("kind", F.col("canon").alias("surrogate"))
        taken = real if done is None else real.union(done.select("kind", "surrogate"))
        good = first.join(taken, ["kind", "surrogate"], "left_anti").withColumn("good", F.lit(True))
        settled = written(drawn.join(good, ["kind", "canon", "surrogate"], "left"), "surrogates")
        new = settled.where("good").select("kind", "canon", "surrogate")
        done = new if done is None else done.union(new)
        left = settled.where("good is null").select("kind", "canon", (F.col("draw") + 1).alias("draw"))
        if left.isEmpty():
            return done
        pending = left


def _word(surrogate: str, word: str) -> str:
    """A word of a name in the case of the mention that it replaces."""
    return f"case when length({word}) > 1 and {word} = upper({word}) then upper({surrogate}) else initcap({surrogate}) end"


def _rendered() -> str:
    """A surface with the surrogates of its parts, in the surface's own format and case."""
    s = "made[0]"
    nth = r"length(regexp_replace(left(surface, i), r'\D', ''))"
    skip = rf"(length(regexp_replace(surface, r'\D', '')) - case when kind = 'phone' then 10 else length({s}) end)"
    digits = f"""array_join(transform(sequence(1, length(surface)), i -> case
        when substr(surface, i, 1) rlike '[0-9]' and {nth} > {skip} then substr({s}, {nth} - {skip}, 1)
        else substr(surface, i, 1) end), '')"""
    cased = _let("sc", f"split({s}, '')", r"""array_join(transform(split(surface, ''), (ch, i) -> case
        when ch rlike r'\p{Lu}' then upper(sc[i]) else sc[i] end), '')""")
    titles = f"regexp_extract(surface, {_sql(f'^{TITLES}+')}, 0)"
    names = f"substr(surface, length({titles}) + 1)"
    words = f"split({names}, '[ -]')"
    gaps = f"regexp_extract_all({names}, '[ -]', 0)"
    return rf"""case
        when kind in {NAMES} then concat({titles},
            array_join(transform({words}, (w, i) -> concat({_word("made[i]", "w")}, coalesce(get({gaps}, i), ''))), ''))
        when kind in ('national', 'card', 'abroad') and length({s}) <= length(regexp_replace(surface, r'\D', '')) then {digits}
        when kind = 'phone' and length({s}) = 10 then {digits}
        when kind = 'secret' then {s}
        when length({s}) = length(surface) then {cased}
        when surface = upper(surface) then upper({s}) else {s} end"""


def _mentions(found: DataFrame) -> DataFrame:
    """``h, surface, pos, kind, canon`` of every entity of ``found (h, surface)``, given names with the
    gender that their document settles."""
    parts = written(
        found.select("surface").distinct().withColumn("parts", F.expr(_parts())).selectExpr("surface", "posexplode(parts) as (pos, part)").select(
            "surface", "pos", "part.*"
        ),
        "parts",
    )
    given = parts.where("kind = 'given'")
    # The genders that a given name has in a document, under any form of address.
    seen = found.join(given, "surface").where("gender != ''").groupBy("h", "canon").agg(
        F.min("gender").alias("least"), F.max("gender").alias("most")
    )
    settled = seen.where("least = most").select("h", "canon", F.col("least").alias("settled"))
    mentioned = found.join(given, "surface").join(settled, ["h", "canon"], "left")
    gender = F.coalesce(F.when(F.col("gender") != "", F.col("gender")), F.col("settled"))
    named = mentioned.withColumn("kind", F.concat_ws("_", F.lit("given"), gender))
    columns = ["h", "surface", "pos", "kind", "canon"]
    return named.select(*columns).union(found.join(parts.where("kind != 'given'"), "surface").select(*columns))


def replacements(found: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """For ``found (h, surface)``, the distinct surfaces of each text: ``h, surface, rendered``, and ``h,
    canon, surrogate`` for the words of its names that are looked for on their own."""
    mentions = written(_mentions(found), "mentions")
    assigned = written(assign(written(mentions.select("kind", "canon").distinct(), "kinds"), key), "assigned")
    # A surface has one part, or the words of a name; those differ by the genders that documents settle.
    by_name = F.expr(f"kind in {NAMES}")
    variant = F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("pos", "kind"))), lambda x: x["kind"]))
    names = mentions.where(by_name).groupBy("h", "surface").agg(variant.alias("variant"))
    others = mentions.where(~by_name).select("surface", "kind", "canon").distinct()
    variants = names.select("surface", "variant").distinct().withColumn("parts", F.expr(_parts())).selectExpr(
        "surface", "variant", "split(variant, ',') as kinds", "posexplode(parts) as (pos, part)"
    )
    words = variants.select("surface", "variant", "pos", F.expr("kinds[pos]").alias("kind"), F.col("part.canon").alias("canon"))
    pieces = words.union(others.selectExpr("surface", "'' as variant", "0 as pos", "kind", "canon"))
    whole = pieces.join(assigned, ["kind", "canon"]).groupBy("surface", "variant").agg(
        F.min_by("kind", "pos").alias("kind"),
        F.expr("transform(array_sort(collect_list(struct(pos, surrogate))), x -> x.surrogate)").alias("made"),
    )
    rendered = written(whole.select("surface", "variant", F.expr(_rendered()).alias("rendered")), "rendered")
    in_text = names.union(mentions.where(~by_name).select("h", "surface", F.lit("").alias("variant")).distinct())
    # A word that is a given name in the text stands for that, else for a surname.
    one = mentions.where(by_name & (F.length("canon") >= LEAST_WORD)).groupBy("h", "canon").agg(F.min("kind").alias("kind"))
    return (
        in_text.join(rendered, ["surface", "variant"]).select("h", "surface", "rendered"),
        one.join(assigned, ["kind", "canon"]).select("h", "canon", "surrogate"),
    )


#: Letters that a word of a name has at least to be looked for without a form of address.
LEAST_WORD = 3


def _bare(segment: str) -> str:
    """A ``segment`` of text with the words of ``__names`` replaced: (text, number of them)."""
    word = f"__names[lower({'hits[i]'})]"
    joined = f"""array_join(transform(split(seg, __pattern, -1), (p, i) -> concat(p,
        if(i < size(hits), {_word(word, 'hits[i]')}, ''))), '')"""
    pair = f"named_struct('text', {joined}, 'n', size(hits))"
    found = _let("hits", "regexp_extract_all(seg, __pattern, 0)", pair)
    return f"if(__names is null, named_struct('text', {segment}, 'n', 0), {_let('seg', segment, found)})"


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text`` and their number in ``n_entities`` (which it replaces).

    Texts without entities, empty and null ones stay as they are, with 0 entities. All other columns
    are kept, as are repeated rows. Only texts with entities are shuffled; of the others the table with
    the marks is all that is written.
    """
    plain = docs.select(*[c for c in docs.columns if c != "n_entities"])
    found_here = F.coalesce(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)), F.array().cast("array<string>"))
    marked = written(plain.withColumn("__found", found_here), "marked")
    has = F.size("__found") > 0
    held = written(marked.where(has).withColumn("__h", F.md5("text")), "held")
    found = written(
        held.select(F.col("__h").alias("h"), F.explode(F.array_distinct("__found")).alias("surface")).distinct(),
        "entities",
    )
    surfaces, words = replacements(found, key)
    made = surfaces.groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("surface", "rendered"))).alias("__made"))
    names = words.groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("canon", "surrogate"))).alias("__names"))
    by_text = made.join(names, "h", "left").withColumnRenamed("h", "__h")
    alternatives = r"array_join(transform(map_keys(__names), w -> concat('\\Q', w, '\\E')), '|')"
    pattern = rf"concat(r'(?<![\p{{L}}\p{{N}}])(?=\p{{Lu}})(?iu:', {alternatives}, r')(?![\p{{L}}\p{{N}}])')"
    changed = (
        held.withColumn("__rest", F.split("text", PATTERN, -1))
        .join(by_text, "__h")
        .withColumn("__pattern", F.expr(pattern))
        .withColumn("__rest", F.expr(f"transform(__rest, r -> {_bare('r')})"))
        .withColumns(
            {
                "text": F.expr(
                    "concat(__rest[0].text, array_join(transform(__found, (s, i) -> concat(__made[s], __rest[i + 1].text)), ''))"
                ),
                "n_entities": F.expr("cast(size(__found) + aggregate(__rest, 0, (s, r) -> s + r.n) as bigint)"),
            }
        )
    )
    columns = [*plain.columns, "n_entities"]
    return marked.where(~has).withColumn("n_entities", F.lit(0).cast("long")).select(*columns).union(
        changed.select(*columns)
    )


def without_personal_data(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates, in the columns of ``docs``; a column ``n_chars`` follows the new text."""
    done = replace_entities(docs.withColumnRenamed("n_entities", "__n"), key)
    size = F.length("text").cast("long").alias("n_chars")
    own = {"n_chars": size, "n_entities": F.col("__n").alias("n_entities")}
    return done.select(*[own[c] if c in own and c in docs.columns else F.col(c) for c in docs.columns])
