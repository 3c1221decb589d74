"""Formal invoices in XML as flat text: parties, rows, grounds and remarks, by Spark's own XML parser.

`canonical` gives each document a full text, a text of its subject alone, and its fields. Region and city
names are the caller's tables, `Places`. Element names and short tokens are those of the format (fixed values).
Where an element that the format has once stands several times, the parser takes one of them.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: What kind of goods a row is about.
KINDS = {"1": "имущество", "2": "работа", "3": "услуга", "4": "права", "5": "иное"}
_PERSON = "struct<_Фамилия string, _Имя string, _Отчество string>"
_PARTY = (
    "struct<ИдСв struct<СвЮЛУч struct<_НаимОрг string, _ИННЮЛ string>, "
    f"СвИП struct<_ИННФЛ string, ФИО {_PERSON}>, СвИнНеУч struct<_Наим string, _Идентиф string>, СвФЛУч struct<_ИННФЛ string, ФИО {_PERSON}>>, "
    "Адрес struct<АдрРФ struct<_КодРегион string, _НаимРегион string, _Город string, _НаселПункт string>, "
    "АдрГАР struct<Регион string, НаимРегион string, НаселенПункт string>, АдрИнф struct<_АдрТекст string>>>"
)
_INFO = "struct<ТекстИнф array<struct<_Идентиф string, _Значен string>>>"
_HEAD = (
    "struct<_НомерДок string, _НомерКСчФ string, _ДатаДок string, _ДатаКСчФ string, СчФ struct<_НомерСчФ string, _ДатаСчФ string>, "
    f"СвПрод {_PARTY}, СвПокуп {_PARTY}, ДенИзм struct<_НаимОКВ string>, ДопСвФХЖ1 struct<_ИдГосКон string, _НаимОКВ string>, ИнфПолФХЖ1 {_INFO}>"
)
_TABLE = (
    "struct<СведТов array<struct<_НаимТов string, _НаимЕдИзм string, ДопСведТов struct<_ХарактерТов string, _ПрТовРаб string, "
    f"_КодТовОКПД2 string, _НаимЕдИзмДо string>, ИнфПолФХЖ2 array<{_INFO}>>>, "
    "ВсегоОпл struct<_СтТовУчНалВсего string, СтТовУчНал struct<_СтоимПослеИзм string, _СтоимДоИзм string>>>"
)
_HANDOVER = (
    "struct<СвПер struct<_СодОпер string, _ВидОпер string, ОснПер array<struct<_РеквНаимДок string, _РеквНомерДок string, _РеквДатаДок string>>>, "
    f"ИнфПолФХЖ3 {_INFO}>"
)
#: The parts of the format that are read. SQL takes such names only between back quotes.
SCHEMA = re.sub(
    r"(\w+) (?=string|struct|array|int)", r"`\1` ",
    f"Документ struct<_Функция string, _НаимДокОпр string, СвСчФакт {_HEAD}, СвКСчФ {_HEAD}, ТаблСчФакт {_TABLE}, ТаблКСчФ {_TABLE}, "
    f"СвПродПер {_HANDOVER}>, _broken string",
)
_TOWN = r"(?:г\.о\.|г\.?)\s*([А-ЯЁ][а-яё]{2,}(?:[\- ][А-ЯЁа-яё]+)?)"
_NO_TOWN = (
    "муниципальный", "городской", "внутригородская", "территория", "округ", "район", "муниципальное", "образование", "городское",
    "сельское", "поселение", "территориальный",
)


@dataclass(frozen=True)
class Places:
    """Region names by code, region names by a key that a text holds (the first that fits), and towns."""

    regions: dict[str, str] = field(default_factory=dict)
    keys: dict[str, str] = field(default_factory=dict)
    towns: tuple[str, ...] = ()


def tidy(c: Column, most: int | None = None) -> Column:
    """Text with single blanks, cut to `most` characters; empty for null."""
    out = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))
    return F.rtrim(F.substring(out, 1, most)) if most else out


def said(c: Column) -> Column:
    """c, null if it is empty."""
    return F.when(c != "", c)


def _first(text: Column, names: dict[str, str], otherwise: Column) -> Column:
    """The name of the first key that the text holds."""
    low = F.lower(text)
    return reduce(lambda out, kv: F.when(F.contains(low, F.lit(kv[0])), kv[1]).otherwise(out), reversed(names.items()), otherwise)


def region(address: Column, places: Places) -> Column:
    """Region of an address: by code or name of its structured form, of its register form, else by a key in its text."""

    def by_code(code: Column) -> Column:
        if not places.regions:
            return F.lit(None).cast("string")
        # A look-up makes the code once, not once for each region.
        return F.try_element_at(F.create_map(*(F.lit(x) for kv in places.regions.items() for x in kv)), code)

    def by_name(name: Column) -> Column:
        bare = F.regexp_replace(tidy(name), r"(?iu)^(г\.?\s+|Респ\.?\s+|Республика\s+)", "")
        return F.when(said(name).isNotNull(), _first(bare, places.keys, bare))

    plain, register = address["АдрРФ"], address["АдрГАР"]
    code = tidy(register["Регион"])
    found = [
        by_code(tidy(plain["_КодРегион"])), by_name(said(tidy(plain["_НаимРегион"]))), by_name(register["НаимРегион"]), by_code(code), said(code),
        _first(F.coalesce(address["АдрИнф"]["_АдрТекст"], F.lit("")), places.keys, F.lit("")),
    ]
    return F.coalesce(*found, F.lit(""))


def town(address: Column, places: Places) -> Column:
    """Town of an address: an attribute, else named in the text, else one of the known towns in it, else by register."""
    plain, text = address["АдрРФ"], F.coalesce(address["АдрИнф"]["_АдрТекст"], F.lit(""))
    named = F.filter(F.regexp_extract_all(text, F.lit(_TOWN), 1), lambda x: ~F.lower(x).isin(*_NO_TOWN))
    known = _first(text, {t.lower(): t for t in places.towns}, F.lit(None).cast("string"))
    return F.coalesce(said(tidy(plain["_Город"])), said(tidy(plain["_НаселПункт"])), F.get(named, 0), known, tidy(address["АдрГАР"]["НаселенПункт"]))


def party(p: Column, places: Places) -> dict[str, Column]:
    """name, inn, region, town: of an organisation, a sole trader, a foreigner or a person, in this order."""
    who = p["ИдСв"]
    person = lambda x: F.concat_ws(" ", *(said(x["ФИО"][f"_{part}"]) for part in ("Фамилия", "Имя", "Отчество")))
    kinds = [("СвЮЛУч", lambda x: x["_НаимОрг"], "_ИННЮЛ"), ("СвИП", person, "_ИННФЛ"), ("СвИнНеУч", lambda x: x["_Наим"], "_Идентиф"), ("СвФЛУч", person, "_ИННФЛ")]
    name = inn = F.lit("")
    for kind, named, number in reversed(kinds):
        name = F.when(who[kind].isNotNull(), tidy(named(who[kind]), 200)).otherwise(name)
        inn = F.when(who[kind].isNotNull(), tidy(who[kind][number])).otherwise(inn)
    return {"name": name, "inn": inn, "region": region(p["Адрес"], places), "town": town(p["Адрес"], places)}


def party_text(name: Column, inn: Column, region: Column, town: Column) -> Column:
    """Name, tax number and place; a region that repeats the town, or is part of it, is left out."""
    in_other = F.contains(F.lower(town), F.lower(region)) | F.contains(F.lower(region), F.lower(town))
    place = F.concat_ws(", ", F.concat(F.lit("г. "), said(town)), F.when((town == "") | ~in_other, said(region)))
    return F.concat(name, _labelled(" (ИНН ", inn, ")"), _labelled(" Рег: ", place))


def _labelled(before: str, c: Column, after: str = "") -> Column:
    return F.when(c != "", F.concat(F.lit(before), c, F.lit(after))).otherwise("")


def info(block: Column, most: int) -> Column:
    """key=value pairs of a block of remarks, cut to `most` characters."""

    def pair(x: Column) -> Column:
        key, value = tidy(x["_Идентиф"], 100), tidy(x["_Значен"], 200)
        return F.when(key != "", F.concat(key, F.lit("="), value)).otherwise(value)

    pairs = F.filter(F.transform(F.coalesce(block["ТекстИнф"], F.array()), pair), lambda x: x != "")
    return F.substring(F.array_join(pairs, "; "), 1, most)


def _runs(lines: Column, shown: Callable[[Column], Column]) -> Column:
    """Neighbours with the same body as one, each shown from struct(body, first, last, n); empty bodies don't count."""
    one = "array<struct<body string, first int, last int, n int>>"

    def step(out: Column, line: Column) -> Column:
        last = F.get(out, F.size(out) - 1)
        new = F.struct(line["body"].alias("body"), line["at"].alias("first"), line["at"].alias("last"), F.lit(1).alias("n"))
        more = F.struct(last["body"].alias("body"), last["first"].alias("first"), line["at"].alias("last"), (last["n"] + 1).alias("n"))
        same = F.coalesce(last["body"] == line["body"], F.lit(False))
        return F.when(same, F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(more))).otherwise(F.concat(out, F.array(new)))

    return F.transform(F.aggregate(F.filter(lines, lambda x: x["body"] != ""), F.array().cast(one), step), shown)


def _row_parts(row: Column, most: int) -> Column:
    more = row["ДопСведТов"]
    name = F.coalesce(said(tidy(row["_НаимТов"], 300)), tidy(more["_ХарактерТов"], 300))
    kind = reduce(lambda out, kv: F.when(more["_ПрТовРаб"] == kv[0], f"вид:{kv[1]}").otherwise(out), KINDS.items(), F.lit(None).cast("string"))
    code, unit = tidy(more["_КодТовОКПД2"], 40), F.coalesce(said(tidy(row["_НаимЕдИзм"], 30)), tidy(more["_НаимЕдИзмДо"], 30))
    extras = F.concat_ws("; ", kind, F.concat(F.lit("ОКПД2:"), said(code)), F.concat(F.lit("ед:"), said(unit)))
    remarks = F.filter(F.transform(F.coalesce(row["ИнфПолФХЖ2"], F.array()), lambda b: info(b, most)), lambda x: x != "")
    subject = F.concat(name, _labelled(" [", extras, "]"))
    return F.struct(subject.alias("subject"), F.concat(subject, _labelled(" {Доп2: ", F.array_join(remarks, "; "), "}")).alias("full"))


def canonical(documents: DataFrame, places: Places, xml: str = "xml", rows: int = 5, remarks: int = 500, grounds: int = 300) -> DataFrame:
    """documents with `ok`, `error`, `full_text`, `subject_text` and `fields`, instead of the XML.

    Null, empty or broken XML, or XML of another kind, gives ok = false, an error and empty texts; nothing fails.
    Of the table, the first `rows` rows are shown; like neighbours are one, with their number.
    """
    source = F.ltrim(F.regexp_replace(F.coalesce(F.col(xml), F.lit("")), r"^\s*<\?xml[^?]*\?>", ""))
    parsed = F.from_xml(source, SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    out = documents.withColumn("_x", parsed).withColumn("_blank", F.trim(source) == "").drop(xml)
    doc = F.col("_x")["Документ"]
    error = F.when(F.col("_blank"), "empty").when(F.col("_x")["_broken"].isNotNull(), "broken").when(doc.isNull(), "no document")
    head = F.coalesce(doc["СвСчФакт"], doc["СвКСчФ"])
    out = out.withColumn("_error", error).withColumn("_head", head).withColumn("_table", F.coalesce(doc["ТаблСчФакт"], doc["ТаблКСчФ"])).withColumn("_given", doc["СвПродПер"])
    # Parts that are shown several times are columns of their own: what is taken out of a struct is made anew at each place.
    sides = {"seller": "СвПрод", "buyer": "СвПокуп"}
    out = out.withColumns({f"_{side}_{part}": c for side, name in sides.items() for part, c in party(F.col("_head")[name], places).items()})

    head, table, given = (F.col(c) for c in ("_head", "_table", "_given"))
    seller, buyer = ({part: F.col(f"_{side}_{part}") for part in ("name", "inn", "region", "town")} for side in sides)
    number = F.coalesce(said(tidy(head["_НомерДок"], 60)), tidy(head["_НомерКСчФ"], 60))
    date = F.coalesce(said(tidy(head["_ДатаДок"], 20)), tidy(head["_ДатаКСчФ"], 20))
    corrected = tidy(head["СчФ"]["_НомерСчФ"], 60)
    corrected = F.when(corrected != "", F.trim(F.concat(F.lit("СФ №"), corrected, F.lit(" от "), tidy(head["СчФ"]["_ДатаСчФ"], 20)))).otherwise("")
    foreign = lambda c: F.when(~F.contains(F.lower(c), F.lit("рубл")), said(c))
    currency = F.coalesce(foreign(tidy(head["ДенИзм"]["_НаимОКВ"], 50)), foreign(tidy(head["ДопСвФХЖ1"]["_НаимОКВ"], 50)), F.lit(""))
    contract = tidy(head["ДопСвФХЖ1"]["_ИдГосКон"], 60)
    of_all = table["ВсегоОпл"]
    changed = of_all["СтТовУчНал"]
    total = F.coalesce(said(tidy(of_all["_СтТовУчНалВсего"], 30)), tidy(F.coalesce(said(changed["_СтоимПослеИзм"]), changed["_СтоимДоИзм"]), 30))
    listed = F.coalesce(table["СведТов"], F.array())
    handed = given["СвПер"]

    def ground(x: Column) -> Column:
        return F.concat_ws(" ", said(tidy(x["_РеквНаимДок"], 80)), F.concat(F.lit("№"), said(tidy(x["_РеквНомерДок"], 60))), said(tidy(x["_РеквДатаДок"], 20)))

    bases = F.filter(F.transform(F.coalesce(handed["ОснПер"], F.array()), ground), lambda x: x != "")
    joined = F.concat_ws("; ", said(corrected), said(F.array_join(bases, "; ")))
    fields = {
        "function": tidy(doc["_Функция"]), "title": tidy(doc["_НаимДокОпр"], 150), "number": number, "date": date, "corrected": corrected,
        "seller_name": seller["name"], "seller_inn": seller["inn"], "seller_region": seller["region"], "seller_city": seller["town"],
        "buyer_name": buyer["name"], "buyer_inn": buyer["inn"], "currency": currency, "contract": contract, "total": total,
        "grounds": F.when(handed.isNotNull(), F.substring(joined, 1, grounds)).otherwise(""),
        "n_rows": F.size(listed), "n_shown": F.least(F.size(listed), F.lit(rows)),
    }
    out = out.withColumns({f"_f_{n}": c for n, c in fields.items()})
    out = out.withColumn("_rows", F.transform(F.slice(listed, 1, rows), lambda r: _row_parts(r, remarks)))

    f, lines = {n: F.col(f"_f_{n}") for n in fields}, F.col("_rows")
    bodies = lambda which: F.transform(lines, lambda r, i: F.struct(r[which].alias("body"), (i + 1).alias("at")))
    times = lambda r: F.when(r["n"] > 1, F.concat(F.lit(" (×"), r["n"].cast("string"), F.lit(")"))).otherwise("")
    span = lambda r: F.when(r["n"] > 1, F.concat(r["first"].cast("string"), F.lit("-"), r["last"].cast("string"))).otherwise(r["first"].cast("string"))
    full_rows = _runs(bodies("full"), lambda r: F.concat(F.lit("Т"), span(r), F.lit(": "), r["body"], times(r)))
    subject = _runs(bodies("subject"), lambda r: F.concat(r["body"], times(r)))
    operation = tidy(handed["_СодОпер"], 150)
    segments = [
        F.when((f["number"] != "") | (f["date"] != ""), F.trim(F.concat(F.lit("№"), f["number"], F.lit(" от "), f["date"]))).otherwise(""),
        _labelled("Прод: ", party_text(seller["name"], seller["inn"], seller["region"], seller["town"])),
        _labelled("Пок: ", F.trim(F.concat(buyer["name"], _labelled(" (ИНН ", buyer["inn"], ")")))),
        _labelled("Вал: ", foreign(tidy(head["ДенИзм"]["_НаимОКВ"], 50))), _labelled("ГК: ", f["contract"]),
        F.when(foreign(tidy(head["ДенИзм"]["_НаимОКВ"], 50)).isNull(), _labelled("Вал: ", f["currency"])),
        _labelled("Доп1: ", info(head["ИнфПолФХЖ1"], remarks)),
    ]
    after = [
        _labelled("Сумма: ", f["total"]), F.when(~T.ritual(operation), _labelled("Опер: ", operation)), _labelled("ВидОп: ", tidy(handed["_ВидОпер"], 80)),
        _labelled("Осн: ", f["grounds"]), _labelled("Доп3: ", info(given["ИнфПолФХЖ3"], remarks)),
    ]
    full = F.array_join(F.filter(F.concat(F.array(*segments), full_rows, F.array(*after)), lambda x: x.isNotNull() & (x != "")), " | ")
    ok = F.col("_error").isNull()
    return out.select(
        *(F.col(c) for c in documents.columns if c != xml), ok.alias("ok"), F.coalesce("_error", F.lit("")).alias("error"),
        F.when(ok, full).otherwise("").alias("full_text"), F.when(ok, F.array_join(subject, " | ")).otherwise("").alias("subject_text"),
        F.when(ok, F.struct(*(c.alias(n) for n, c in f.items()))).alias("fields"),
    )
