"""The canonical text of formal invoices."""

from lodestone.operators import invoices

PLACES = invoices.Places({"77": "Москва", "16": "Татарстан"}, {"татарстан": "Татарстан", "тверская обл": "Тверская обл"}, ("Казань", "Тверь"))
UTD = """<?xml version="1.0" encoding="windows-1251"?>
<Файл><Документ Функция="СЧФДОП" НаимДокОпр="Передача">
<СвСчФакт НомерДок="12" ДатаДок="01.02.2025">
<СвПрод><ИдСв><СвЮЛУч НаимОрг="ООО  Ромб" ИННЮЛ="7700000001"/></ИдСв><Адрес><АдрРФ КодРегион="77" Город="Москва"/></Адрес></СвПрод>
<СвПокуп><ИдСв><СвИП ИННФЛ="160000000002"><ФИО Фамилия="Ива" Имя="Вяз"/></СвИП></ИдСв></СвПокуп>
<ДенИзм НаимОКВ="Юань"/><ДопСвФХЖ1 ИдГосКон="К-1"/>
<ИнфПолФХЖ1><ТекстИнф Идентиф="ключ" Значен="а"/><ТекстИнф Значен="б"/></ИнфПолФХЖ1>
</СвСчФакт>
<ТаблСчФакт>
<СведТов НаимТов="Болт" НаимЕдИзм="шт"><ДопСведТов ПрТовРаб="1" КодТовОКПД2="25.94"/></СведТов>
<СведТов НаимТов="Болт" НаимЕдИзм="шт"><ДопСведТов ПрТовРаб="1" КодТовОКПД2="25.94"/></СведТов>
<СведТов НаимТов="Гайка"><ИнфПолФХЖ2><ТекстИнф Идентиф="з" Значен="7"/></ИнфПолФХЖ2></СведТов>
<СведТов/><СведТов НаимТов="Шайба"/><СведТов НаимТов="Шестая"/>
<ВсегоОпл СтТовУчНалВсего="100.50"/>
</ТаблСчФакт>
<СвПродПер><СвПер СодОпер="Услуги оказаны полностью" ВидОпер="Продажа"><ОснПер РеквНаимДок="Договор" РеквНомерДок="5" РеквДатаДок="01.01.2025"/><ОснПер РеквНаимДок="Заказ"/></СвПер>
<ИнфПолФХЖ3><ТекстИнф Идентиф="р" Значен="2"/></ИнфПолФХЖ3></СвПродПер>
</Документ></Файл>"""
CORRECTION = """<Файл><Документ Функция="КСЧФ"><СвКСчФ НомерКСчФ="3" ДатаКСчФ="05.05.2025"><СчФ НомерСчФ="9" ДатаСчФ="01.05.2025"/>
<СвПрод><ИдСв><СвИнНеУч Наим="Foreign" Идентиф="X1"/></ИдСв><Адрес><АдрИнф АдрТекст="Тверская обл., г. Район, Тверь"/></Адрес></СвПрод>
<ДопСвФХЖ1 НаимОКВ="Евро"/></СвКСчФ>
<ТаблКСчФ><СведТов><ДопСведТов ХарактерТов="Опора" НаимЕдИзмДо="т"/></СведТов><ВсегоОпл><СтТовУчНал СтоимДоИзм="8"/></ВсегоОпл></ТаблКСчФ>
<СвПродПер><СвПер СодОпер="Изменение цены"/></СвПродПер></Документ></Файл>"""
REGISTER = """<Файл><Документ><СвСчФакт><СвПрод><ИдСв><СвФЛУч ИННФЛ="5"><ФИО Имя="Ян"/></СвФЛУч></ИдСв>
<Адрес><АдрГАР><Регион>16</Регион><НаимРегион>Республика Татарстан (Татарстан)</НаимРегион><НаселенПункт>Казань</НаселенПункт></АдрГАР></Адрес></СвПрод></СвСчФакт></Документ></Файл>"""


def test_invoices(spark):
    rows = [(1, UTD), (2, CORRECTION), (3, REGISTER), (4, ""), (5, None), (6, "<Файл><Документ"), (7, "<Файл><Иное/></Файл>")]
    out = {r["id"]: r for r in invoices.canonical(spark.createDataFrame(rows, "id long, xml string"), PLACES).collect()}
    assert [out[i]["error"] for i in range(1, 8)] == ["", "", "", "empty", "empty", "broken", "no document"]
    assert out[1]["full_text"] == (
        "№12 от 01.02.2025 | Прод: ООО Ромб (ИНН 7700000001) Рег: г. Москва | Пок: Ива Вяз (ИНН 160000000002) | Вал: Юань | ГК: К-1 | Доп1: ключ=а; б | "
        "Т1-2: Болт [вид:имущество; ОКПД2:25.94; ед:шт] (×2) | Т3: Гайка {Доп2: з=7} | Т5: Шайба | Сумма: 100.50 | ВидОп: Продажа | "
        "Осн: Договор №5 01.01.2025; Заказ | Доп3: р=2"
    )
    assert out[1]["subject_text"] == "Болт [вид:имущество; ОКПД2:25.94; ед:шт] (×2) | Гайка | Шайба"
    f = out[1]["fields"]
    assert (f["n_rows"], f["n_shown"], f["total"], f["currency"], f["seller_region"], f["buyer_name"]) == (6, 5, "100.50", "Юань", "Москва", "Ива Вяз")
    assert out[2]["full_text"] == (
        "№3 от 05.05.2025 | Прод: Foreign (ИНН X1) Рег: г. Тверь, Тверская обл | Вал: Евро | Т1: Опора [ед:т] | Сумма: 8 | Опер: Изменение цены | Осн: СФ №9 от 01.05.2025"
    )
    assert out[3]["full_text"] == "Прод: Ян (ИНН 5) Рег: г. Казань, Татарстан"
    assert all(out[i]["full_text"] == "" and not out[i]["ok"] for i in range(4, 8))


def test_empty_table(spark):
    assert invoices.canonical(spark.createDataFrame([], "id long, xml string"), PLACES).count() == 0
