"""The labelled table from which the tagger of ``pii`` is trained.

Every row is one line put together from a grammar: a lead, a labelled stretch and a tail, or a sentence without any, in one of six
languages, dressed as prose, list, table cell, template field, comment, note or signature. The leads and sentences are our own, of a
kind found in letters, notices and wikis anywhere; none is taken from a corpus that is searched. {name}, {email}, {phone}, {id_number} and
{address} are the labelled stretches. Names of persons are put together from halves of the lexicon's, names of places, bodies and users and
most hosts from random syllables, so that the tagger learns how such things look rather than which there are.

``labelled_rows(..., forms=...)`` takes the forms of one part only, so that accuracy can be measured on forms never trained on.
"""

from __future__ import annotations

import random

LABELLED = ("name", "email", "phone", "id_number", "address")

#: Leads before a labelled stretch, by type and language; a lead may end in a colon or not.
LEADS = {
    "email": {
        "en": "Contact|E-mail|email|Mail|Write to|Reach us at|Send comments to|Questions go to|please mail|Forward the scans to|You can reach me via|His address is|Enquiries|Reply to|complaints to|and cc|or drop a line to|corrections by mail to|Webmaster|For copies ask|everybody spam|my address|Address corrections to|errors should be reported to|let us know at|feedback welcome at|messages to|or e-mail|use|forwarded by",
        "de": "Kontakt|E-Mail an|Zuschriften an|Mail|Rückfragen bitte an|erreichbar unter|oder per Mail an|Anfragen an|Hinweise an|Fehler bitte melden an", "fr": "Courriel|Contact|Adresse électronique|écrivez à|Réponses à|ou par courriel à|Merci d'envoyer à|Signaler une erreur à",
        "es": "Correo|Contacto|Escriba a|Envíe sus notas a|o por correo a|Respuestas a|Avisos a|Dudas a", "pl": "E-mail|Kontakt|Proszę pisać na|Pytania kierować na|lub mailem na|Zgłoszenia na|Poprawki na", "ru": "Почта|Эл. почта|Пишите на|Вопросы направлять на|или на адрес|Связь|Замечания присылать на",
    },
    "phone": {
        "en": "Phone|Tel.|Telephone|Call|ring|Mobile|Fax|or phone|Dial|text|Reach the desk on|Office hours by phone|tel|Ask for details on|answered on|or leave a message at|home phone|The porter picks up on|Landline|hotline|bookings on|give us a ring on|my number is|was reached on|phone number|contact number",
        "de": "Tel.|Telefon|Fax|Mobil|Rufnummer|erreichbar unter|Anruf unter|Telefonnummer|oder telefonisch", "fr": "Tél.|Téléphone|Portable|Appeler le|Fax|ou par téléphone au|joignable au|numéro", "es": "Teléfono|Tel.|Llame al|Móvil|Fax|o al número|tel.",
        "pl": "Tel.|Telefon|Dzwonić|Komórka|Faks|numer telefonu|tel. kom.", "ru": "Тел.|Телефон|Звоните|Факс|моб.|по телефону|номер телефона",
    },
    "id_number": {
        "en": "ID|ID number|Passport|passport no.|Passport number|National ID|Social security number|SSN|Membership no.|member number|card no.|Identity card|Reader's ticket|insurance number|Staff no.|licence no.|id|his national number|Library card|Member card|found a card numbered|bearer of document|registered under|identified by|tax number|national no.|Membership number|identity no.|pass|ticket holder",
        "de": "Ausweis Nr.|Personalausweis|Passnummer|Mitgliedsnummer|Steuernummer|Versicherungsnummer|Reisepass|Ausweisnummer|Mitglied Nr.", "fr": "Carte d'identité n°|Passeport|Numéro de membre|Pièce d'identité|N° de sécurité sociale|carte n°|Numéro national|document nº",
        "es": "DNI|Pasaporte|Documento n.º|Número de socio|Cédula|carné|Documento|N.º de identidad", "pl": "Dowód|PESEL|Paszport|Nr legitymacji|Numer członkowski|numer|nr dowodu|legitymacja", "ru": "Паспорт|Удостоверение №|Членский билет №|СНИЛС|Документ|ИНН|Документ №|Номер пропуска",
    },
    "address": {
        "en": "Address|Postal address|lives at|Visit us at|The parcel went to|Deliver to|moved to|Office|Home address|resides at|Meet at|Send letters to|residence|registered at|The studio is at|Write to|of|came from|was born at|keeps a shop at|the family house,|return to|Please post it to|found at|Delivery|by post to|Before visiting, write to|collected from|went round to",
        "de": "Adresse|Anschrift|wohnhaft|Besucht uns:|wohnt|Büro|Lieferung an|zu finden|Postanschrift", "fr": "Adresse|demeurant|Bureau|habite|Livrer au|domicilié|Adresse postale|Écrire au", "es": "Dirección|domicilio|vive en|Oficina|Enviar a|Entregar en|con domicilio en|reside en",
        "pl": "Adres|zamieszkały|Biuro|mieszka przy|Dostawa|adres domowy|zam.", "ru": "Адрес|проживает|Офис|Доставка|по адресу|зарегистрирован|прописан",
    },
    "name": {
        "en": "Mr|Mrs|Ms|Miss|Dr.|Dr|Prof.|Professor|Sir|Signed,|signed|Author|Keeper|Editor|written by|told by|by|Curator|Contact person|according to|Ask|Owner|Secretary|photo by|donated by|widow of|interview with|Regards,|in care of|Thanks to|Director|His neighbour|Maintained by|compiled by|owner is|I met|I spoke with|Reported by|Chair|the late|a letter from|drawn by|Captain|Rev.|belongs to|lent by|started by|draft by|answered by|names|says|caretaker|warden|hello|kilroy|for|As|from",
        "de": "Herr|Frau|Dr.|Prof.|Ansprechpartner|gezeichnet|Verfasser|von Herrn|Leitung|Inhaber|laut Frau|an Frau|gehört|fragen Sie|bei Herrn|Spende von", "fr": "M.|Mme|Mlle|Dr|Responsable|Auteur|signé|demander|Madame|Monsieur|chez M.|propriétaire|par", "es": "Sr.|Sra.|Dr.|Don|Doña|Autor|Responsable|firmado|el señor|la señora|preguntar por|de",
        "pl": "Pan|Pani|dr|Autor|Opiekun|podpisano|Kontakt|prof.|właściciel|u pana", "ru": "г-н|г-жа|Автор|Проф.|подписал|Ответственный|владелец|доктор|спросить",
    },
}
#: Field names of templates and tables that hold each type.
FIELDS = {
    "email": "email|mail|contact|e-mail|contact_email|reply", "phone": "phone|tel|telephone|fax|contact|mobile", "id_number": "id|passport|card|member_no|national_id|number",
    "address": "address|office|location|street|residence|home", "name": "name|keeper|author|curator|owner|editor|director|person|contact|manager",
}
#: What may follow a labelled stretch, by language.
TAILS = {
    "en": "for details|before noon|(private)|and wait|again|or come by|, thank you|today|if in doubt|for the key|about this|in the evening|as before|was found|in the {word}|lent the {word}|wrote this page|gave the {word} to the {word}|, who {word} it|was here|told me so|wrote in {year}|has the {word}|on the {word}|for the {word}|only|near the {word}|, see above|does not agree|lives there|is my neighbour|was lost|!!!|and ask|, please|(home)|(work)|knows more|repaired the {word}|died in {year}",
    "de": "bitte|ab {n2} Uhr|wegen der {word}|(privat)|oder später|, danke|hat die {word}|schrieb {year}|gefunden", "fr": "avant midi|pour la {word}|(privé)|, merci|ou plus tard|a vu la {word}|écrivit en {year}|perdu", "es": "por favor|para el {word}|(privado)|, gracias|o más tarde|tiene el {word}|murió en {year}",
    "pl": "po południu|w sprawie {word}|(prywatny)|, dziękuję|napisał w {year}|zgubiono", "ru": "после обеда|по делу|(личный)|, спасибо|написал в {year}|потерян",
}
#: Openings and predicates of sentences whose subject is a person.
OPENINGS = "lol|haha|hey|omg|btw|oh|well|so|and|but|then|because|that|where|yesterday|today|in {year}|the {word} of|my friend|our neighbour|{word}|{word}|||||".split("|")
PREDICATES = "lives at|moved to|can be reached at|answers|uses|has the number|carries|was here|likes the {word}|wrote to|came from|is at|took the {word} to|and the {word} of {place}|works at|keeps|left {place} for|is a {word}|{word} the {word}|owns|stays at|asks for".split("|")
#: Sentences without personal information, by language; ⟦ and ⟧ stand for double braces, ⟨ for a single one; {place}, {org}, {user}, {word}, {year} and numbers are filled.
PLAIN = {
    "en": [
        "The {word} of {place} was {word} in {year}.", "{place} has {n} inhabitants and a {word}.", "A {word} leads from {place} to {place}.", "In {year} the {org} bought the {word} near {place}.",
        "Nobody knows why the {word} is {word}.", "The {word} is {n} m long and {n2} m wide.", "It was {word} by the {org} between {year} and {year}.", "See ISBN {isbn} and page {n2} for the {word}.",
        "Catalogue no. {coll} shows a {word}.", "Item {coll} of the {org} is a {word} {word}.", "The road to {place} crosses {place} {street} and {place} {street}.", "They met on {place} {street}, beside the {word}.",
        "Bus {n2} stops in {place} {street}.", "{org}, founded in {year}, keeps {n} volumes.", "Coordinates: {deg} N, {deg} E.", "On {n1} May {year} the {word} reopened; on {date} it closed.", "User {user} moved the page.",
        "Ask @{user} about the {word}.", "--[[User:{user}|{user}]] ([[User talk:{user}|talk]]) {n2}:{n2}, {n1} June {year} (UTC)", ":: I agree. --{user} {n2}:{n2}, {n1} May {year}", "Reverted edits by [[Special:Contributions/{user}|{user}]] to revision {n5}{n3}",
        "== {place} ==", "=== {word} ===", "#REDIRECT [[{place}]]", "[[Category:{word} of {place}]]", "[[File:{place} {word}.jpg|thumb|{place} in {year}]]", "⟦cite book|title={place} {word}|year={year}|isbn={isbn}|page={n2}⟧",
        "<ref>⟦cite web|url=http://www.{word}.org/{n3}/{word}|title={place}|date={date}⟧</ref>", "⟦coord|{n2}|{n2}|{n2}|N|{n2}|{n2}|W⟧", "| population = {n}", "| name = {place}", "| founded = {year}", "| area = {n2}.{n1} km²", "| phone =", "| email =", "| keeper = {org}",
        "| contact = see the talk page", "| coordinates = {deg}, -{deg}", "! {word} !! {word} !! {year}", "| {place} || {year} || {n} || {n2}", "|-", "⟨| class=\"wikitable\"", "Take {n2} {word} and {n1} {word}; wait {n2} minutes.",
        "How many {word} does a {word} need for {n2} {word}?", "The {word} {word} {word} and the {word}, but no {word}.", "Neither {place} nor {place} has a {word}.", "From the {word} one sees {place} and Mount {place}.", "Old {place} and New {place} were joined in {year}.",
        "{org} and {org} shared the {word}.", "His {word}, {word} and {word}, is {word}.", "Version {n1}.{n2}.{n3} needs {n} bytes.", "The score was {n1}:{n1} after {n2} minutes.", "It lies {n2} km north of {place}, {n} m above the sea.", "St. {one} Church in {place} is {word}.",
        "King {one} gave the {word} to {place}.", "The {one} family owned it until {year}.", "{one} {street} is closed.", "Mayor of {place} since {year}.", "Line {n2} ends at {place} {street}.", "{n1} {word}, {n2} {word}, {n3} {word}", "The local name is \"{place}\".",
        "⟦convert|{n2}|km|mi⟧ from {place}⟦citation needed|date=May {year}⟧", "The '''{word}''' is a [[{word}]] in [[{place}]], {place}.", "[[{place}]] [[{word}]] {word} [[{place} {word}]]", "* [[{place}]]", "* {place} {word} ({year})", "{place} – {place} – {place}",
        "{place} {word} is used at the {word}, see {place} {street}.", "[http://www.{word}.org/{n3} {place} {word}]", "It costs {n2} {word} or {n}.", "{word} {word} {word} {word} {word}", "{word}, {word}: {word} ({word})", "The {place} {word} {word} of {year}",
    ],
    "de": ["Die {word} von {place} wurde {year} gebaut.", "{place} hat {n} Einwohner.", "Das {org} kaufte {year} das Haus.", "Die Straße nach {place} ist {n2} km lang.", "Zwischen {place} und {place} liegt ein {word}.", "[[Kategorie:{word} in {place}]]", "Seit {year} gehört es zum {org}.", "== Geschichte ==", "Der {word} steht in der {place}straße neben der {word}.", "Siehe ISBN {isbn}.", "Der Alte {word} von {place} ist klein.", "'''{place}''' ist ein Ort bei {place}."],
    "fr": ["Le {word} de {place} fut construit en {year}.", "La commune compte {n} habitants.", "Le {org} a fermé en {year}.", "La rue de {place} mène au {word}.", "Entre {place} et {place}, il y a {n2} km.", "[[Catégorie:{word} de {place}]]", "Depuis {year}, la {word} appartient au {org}.", "== Histoire ==", "Voir ISBN {isbn}.", "'''{place}''' est un village près de {place}."],
    "es": ["El {word} de {place} se abrió en {year}.", "{place} tiene {n} habitantes.", "La calle de {place} lleva al {word}.", "Desde {year} pertenece al {org}.", "Entre {place} y {place} hay {n2} km.", "[[Categoría:{word} de {place}]]", "== Historia ==", "Véase ISBN {isbn}.", "'''{place}''' es un pueblo cerca de {place}."],
    "pl": ["{place} leży {n2} km od {place}.", "Ulica {place} prowadzi do {word}.", "W {year} roku {word} został zamknięty.", "Miasto ma {n} mieszkańców.", "[[Kategoria:{place}]]", "Od {year} należy do {org}.", "Zobacz ISBN {isbn}.", "'''{place}''' to wieś koło {place}."],
    "ru": ["{place} находится в {n2} км от {place}.", "Улица {place} ведёт к {word}.", "В {year} году {word} закрыт.", "В городе {n} жителей.", "[[Категория:{place}]]", "Музей {place} построен в {year} году.", "См. ISBN {isbn}.", "Старый {word} и новый {word} описаны в {year} году.", "'''{place}''' — село у реки."],
}
#: Common words of each language, for {word}.
WORDS = {
    "en": "house river story garden bridge winter paper music table early simple round broken silent garage corner window letter number problem answer village church school market mountain forest island engine travel history science poem singer doctor painter soldier yellow narrow famous empty heavy written taken found given opened closed measured moved painted lost sold slow deep stone iron wool bread salt water light dark cloud storm summer autumn morning valley field fence gate tower wall roof door bell clock wheel road ship boat harbour fish bird horse cattle museum station theatre council library region language people war peace trade coal glass silk grain".split(),
    "de": "Haus Fluss Garten Brücke Winter Kirche Schule Markt Wald Insel klein alt neu still rund Mühle Turm Bahnhof Dorf Hafen offen leer früh Verein Museum".split(), "fr": "maison rivière jardin pont hiver église école marché forêt île petit ancien nouveau moulin tour gare village port ouvert vide musée chemin".split(),
    "es": "casa río jardín puente invierno iglesia escuela mercado bosque isla pequeño antiguo nuevo molino torre estación pueblo puerto abierto museo camino".split(), "pl": "dom rzeka ogród most zima kościół szkoła rynek las wyspa mały stary nowy młyn wieża dworzec port otwarty muzeum droga".split(),
    "ru": "дом река сад мост зима церковь школа рынок лес остров малый старый новый мельница башня вокзал порт музей дорога озеро".split(),
}
#: Words that make a body or an institution of a name.
BODIES = "Trust Society Board Works Company Museum Library University Club Guild Council Institute Press Group Union Bank Railway Party Church Foundation Agency Theatre College Survey Archive Committee School Hospital Hotel Farm".split()
STREETS = "Street St St. Lane Road Rd Close Avenue Ave Ave. Way Drive Court Crescent Terrace Square Row Hill Gardens".split()
ABROAD = {
    "de": ("weg gasse straße str. platz allee ring damm".split(), "Linden Berg Schul Garten Wald Kirch Rosen Mühlen Bach Feld Hof Burg Tal Eichen".split()),
    "fr": ("rue|avenue|boulevard|place|quai|chemin|impasse|allée".split("|"), "du Lac|de la Paix|des Roses|de l'Église|Victor|des Écoles|du Pont|de la Mairie|Neuve|du Château|des Champs|de la Source".split("|")),
    "es": ("calle|avenida|plaza|paseo|camino|Calle|c/".split("|"), "del Sol|de la Paz|Real|del Río|San Juan|de la Fuente|del Carmen|Ancha|de las Flores|del Prado|Alta".split("|")),
    "pl": ("ul.|al.|pl.|os.".split("|"), "Słoneczna|Szkolna|Krótka|Długa|Kwiatowa|Zielona|Kolejowa|Parkowa|Rynkowa|Górna|Wiśniowa".split("|")),
    "ru": ("ул.|пр.|пер.|наб.|просп.".split("|"), "Школьная|Зелёная|Мира|Советская|Северная|Молодёжная|Центральная|Вокзальная|Парковая|Луговая|Берёзовая".split("|")),
}
SYLLABLES = "bal bor car den dol fal gar gor hal hun kir lam lin mar mel nor oro pel ral ros sal ten tor ul ver wil yor zan bra cle dro fri gle pra sta tri el am ik on ur".split()
ENDINGS = "ton bury ham worth by field wood den ville bach berg hausen mont puy ia ova ino gard minster port bridge well combe gate marsh ley hurst".split()
CYRILLIC = "бор вол гор дуб зар кам лес мир нов пол реч сад тур холм".split()
BEFORE = "Upper Lower Old New Great Little North South East West Port Mount Saint Lake Fort".split()


class Filler:
    def __init__(self, given: list[str], surnames: list[str], seed: int):
        self.rng, self.given, self.surnames = random.Random(seed), given or ["Anna", "Peter"], surnames or ["Miller", "Novak"]

    def digits(self, n: int) -> str:
        return "".join(self.rng.choice("0123456789") for _ in range(n))

    def half(self, names: list[str]) -> str:
        """A name of the lexicon, or one made of the beginning of one and the end of another."""
        r = self.rng
        if r.random() < 0.35:
            return r.choice(names)
        a, b = r.choice(names), r.choice(names)
        i = max(2, len(a) // 2 + r.randint(-1, 1))
        return (a[:i] + b[max(2, len(b) // 2) :]).capitalize()

    def name(self) -> str:
        r, g, s = self.rng, self.half(self.given), self.half(self.surnames)
        x = r.random()
        if x < 0.13:
            s = f"{s}-{self.half(self.surnames)}"
        elif x < 0.24:
            s = f"{r.choice(['van', 'von', 'de', 'del', 'van der', 'di', 'da'])} {s}"
        elif x < 0.36:
            g = f"{g} {r.choice('ABCDEFGHJKLMNPRSTW')}."
        elif x < 0.40:
            g = f"{g} {self.half(self.given)}"
        elif x < 0.43:
            s = r.choice(["Mc", "Mac", "O'"]) + s
        n = f"{s}, {g}" if r.random() < 0.25 else f"{g} {s}"
        return n.upper() if r.random() < 0.04 else n

    def proper(self) -> str:
        r = self.rng
        return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 2))).capitalize() + r.choice(ENDINGS + [""] * 8)

    def place(self, lang: str = "en") -> str:
        r = self.rng
        if lang == "ru" and r.random() < 0.6:
            return (r.choice(CYRILLIC) + r.choice(CYRILLIC)).capitalize() + r.choice(["ка", "ск", "ово", ""])
        p = self.proper()
        x = r.random()
        return f"{r.choice(BEFORE)} {p}" if x < 0.2 else f"{p} {self.proper()}" if x < 0.24 else f"{r.choice(WORDS['en']).capitalize()} {p}" if x < 0.27 else p

    def org(self) -> str:
        r = self.rng
        return f"{r.choice([self.place(), self.half(self.surnames), r.choice(WORDS['en']).capitalize()])} {r.choice(BODIES)}"

    def user(self) -> str:
        r = self.rng
        a, b = r.choice(WORDS["en"]), r.choice([*WORDS["en"], *SYLLABLES])
        return r.choice([(a + " " + b).title().replace(" ", ""), a + b + self.digits(2), a.capitalize() + self.digits(r.randint(1, 4)), f"{a.capitalize()}_{b}", f"{a}_and_{b}".capitalize(), (a + b).capitalize(), self.half(self.given) + self.digits(2)])

    def host(self) -> str:
        r = self.rng
        w = lambda: r.choice([r.choice(WORDS["en"]), self.proper().lower(), r.choice(["mail", "post", "web", "uni"])])
        parts = [r.choice(["", "", "-"]).join([w(), w()])] + ([w()] if r.random() < 0.2 else [])
        return ".".join(parts) + "." + r.choice("example test invalid org com net info de fr es pl eu co.uk".split())

    def email(self) -> str:
        r = self.rng
        g, s = self.half(self.given).lower(), self.half(self.surnames).lower()
        local = r.choice([f"{g}{r.choice(['', '.', '_', '-'])}{s}", f"{g}{r.choice(['.', '_', ''])}{s}", f"{g[0]}{r.choice(['', '.'])}{s}", g, r.choice(["info", "office", "desk", "editor", r.choice(WORDS["en"])])])
        local += r.choice(["", "", "", str(r.randint(1, 99)), "+" + r.choice(["list", "wiki", "news", self.digits(2)])])
        host, x = self.host(), r.random()
        h, _, t = host.rpartition(".")
        m = (
            f"{local}@{host}" if x < 0.5 else f"{local} @ {host}" if x < 0.6 else f"{local}(at){host}" if x < 0.68 else f"{local} (at) {host}" if x < 0.72 else f"{local} [at] {h} [dot] {t}" if x < 0.82
            else f"{local}[at]{h}[dot]{t}" if x < 0.86 else f"{local} (at) {h} (dot) {t}" if x < 0.89 else f"{local}&#64;{host}"
        )
        return m.upper() if r.random() < 0.12 and "t]" not in m and "t)" not in m and "#" not in m else m

    def phone(self) -> str:
        r, d = self.rng, self.digits
        cc = r.choice(["1", "44", "49", "33", "34", "48", "7", "39", "999", str(r.randint(20, 99))])
        groups = [d(r.choice([2, 3, 3, 4])) for _ in range(r.choice([2, 3, 3, 4]))]
        return r.choice([
            f"+{cc} {' '.join(groups)}", f"+{cc}{r.choice('-. ')}{r.choice('-. ').join(groups)}", f"+{cc} ({d(3)}) {d(3)}-{d(4)}", f"({d(3)}) {d(3)}{r.choice('- ')}{d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}-{d(4)}",
            f"0{d(4)} {d(6)}", f"0{d(2)} {d(4)} {d(4)}", f"0{d(3)} {d(3)} {d(4)}", f"(0{d(3)}) {d(6)}", f"0{d(2)}/{d(7)}", f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", f"{d(3)} {d(3)} {d(3)}", f"0{d(3)}-{d(6)}", f"00{cc} {' '.join(groups)}", f"+{cc}{d(9)}",
        ])

    def id_number(self) -> str:
        r, d = self.rng, self.digits
        a = lambda n: "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZ") for _ in range(n))
        return r.choice([d(11), d(11), d(r.choice([9, 10, 12])), f"{a(2)} {d(2)} {d(2)} {d(2)} {a(1)}", f"{a(2)} {d(2)} {d(2)} {d(2)} {a(1)}", f"{a(2)}{d(6)}{a(1)}", f"{a(2)}{d(7)}", f"{a(2)}{d(7)}", f"{a(1)}{d(8)}", f"{a(3)}{d(6)}", f"{d(3)}-{d(2)}-{d(4)}", f"{d(3)}-{d(2)}-{d(4)}", f"{d(8)}{a(1)}", f"{a(3)} {d(6)}"])

    def address(self, lang: str) -> str:
        r = self.rng
        n = str(r.randint(1, 280)) + r.choice(["", "", r.choice("ABCDabc")])
        if lang in ABROAD and r.random() < 0.9:
            kinds, names = ABROAD[lang]
            k, x = r.choice(kinds), r.choice(names)
            if lang == "de":
                return f"{r.choice([x, self.proper(), self.proper()])}{k} {n}" if r.random() < 0.85 else f"{r.choice(['Am', 'An der', 'Im', 'Zum'])} {x} {n}"
            if lang == "fr":
                return f"{n}{r.choice(['', '', ',', ' bis', ' ter,'])} {k} {r.choice([x, x, 'de ' + self.proper()])}"
            if lang == "es":
                return f"{k} {r.choice([x, x, 'de ' + self.proper(), self.proper()])}{r.choice([' ', ', ', ' n.º '])}{n}" + r.choice(["", f", {r.randint(1, 9)}.º {r.choice('ABCD')}", f", {r.randint(1, 9)}º {r.choice('ABCD')}", f", piso {r.randint(1, 9)}"])
            if lang == "pl":
                return f"{k} {x} {n}" + r.choice(["", f"/{r.randint(1, 80)}", f"/{r.randint(1, 80)}", f" m. {r.randint(1, 80)}"])
            return f"{k} {x}, {r.choice(['д. ', 'д. ', 'дом '])}{n}" + r.choice(["", f", кв. {r.randint(1, 99)}", f", кв. {r.randint(1, 99)}", f", корп. {r.randint(1, 5)}"])
        a = f"{n} {r.choice([self.proper(), self.proper(), self.half(self.surnames), r.choice(WORDS['en']).capitalize(), self.place()])} {r.choice(STREETS)}"
        if r.random() < 0.3:
            a = f"{r.choice(['Flat', 'Flat', 'Unit', 'Room', 'Apartment'])} {r.randint(1, 40)}{r.choice(['', '', 'A', 'B'])}, {a}"
        return a + (r.choice([", Apt. ", ", Apt ", ", Suite ", " #", ", Flat "]) + str(r.randint(1, 90)) if r.random() < 0.2 else "")

    def slot(self, what: str, lang: str) -> str:
        r, d = self.rng, lambda n: str(self.rng.randint(10 ** (n - 1), 10**n - 1))
        return {
            "place": lambda: self.place(lang), "org": self.org, "user": self.user, "word": lambda: r.choice(WORDS[lang if r.random() < 0.9 else "en"]), "street": lambda: r.choice(STREETS), "one": lambda: r.choice([self.half(self.given), self.half(self.surnames), self.proper()]),
            "year": lambda: str(r.randint(900, 2029)), "n": lambda: r.choice([d(r.randint(2, 6)), f"{d(r.randint(1, 3))},{d(3)}"]), "n1": lambda: d(1), "n2": lambda: d(2), "n3": lambda: d(3), "n5": lambda: d(5), "deg": lambda: f"{d(2)}.{d(r.randint(2, 5))}",
            "date": lambda: f"{r.randint(1900, 2029)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", "isbn": lambda: r.choice([f"978-{d(1)}-{d(5)}-{d(3)}-{d(1)}", f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"{d(1)}-{d(4)}-{d(4)}-{d(1)}", "978" + d(10)]),
            "coll": lambda: r.choice([f"{r.randint(1850, 2029)}-{d(1)}/{d(r.randint(3, 7))}", f"{r.randint(1850, 2029)}.{d(2)}.{d(3)}", f"{r.choice('ABM')}{d(5)}", f"MS {d(4)}", f"{d(4)}/{d(5)}"]),
        }[what]()

    def fill(self, form: str, lang: str) -> list[tuple[str, str]]:
        out, rest = [], form
        while rest:
            head, brace, tail = rest.partition("{")
            out.append((head, ""))
            if not brace:
                break
            what, _, rest = tail.partition("}")
            out.append((self.address(lang) if what == "address" else getattr(self, what)(), what) if what in LABELLED else (self.slot(what, lang), ""))
        return [(t.replace("⟦", "{{").replace("⟧", "}}").replace("⟨", "{"), label) for t, label in out if t]


def _of(items: list, forms: str) -> list:
    """All items, those of the training part, or those held out: every fifth."""
    return items if forms == "all" else [x for i, x in enumerate(items) if (i % 5 == 4) == (forms == "held out")]


def _stretch(f: Filler, lang: str, kind: str, forms: str) -> list[tuple[str, str]]:
    """A lead and a labelled stretch."""
    r, leads = f.rng, _of(LEADS[kind][lang].split("|"), forms)
    if kind == "name" and r.random() < 0.12:
        return f.fill("{name}", lang)
    lead = r.choice(leads)
    if r.random() < 0.15:
        lead = lead.lower() if r.random() < 0.5 else lead.capitalize()
    gap = " " if lead[-1] in ":," or kind == "name" or r.random() < 0.6 else r.choice([": ", ": ", " - ", ":", " = "])
    close = ""
    if kind == "email" and r.random() < 0.08:
        gap, close = r.choice([(" [mailto:", " " + r.choice(WORDS[lang]) + "]"), (" <", ">"), (" mailto:", "")])
    elif r.random() < 0.06:
        gap, close = r.choice([(" (", ")"), (' "', '"'), (" '''", "'''"), (" ''", "''")])
    return [(lead + gap, ""), *f.fill("{%s}" % kind, lang), (close, "")]


def _town(f: Filler, lang: str, kind: str) -> list[tuple[str, str]]:
    """What may follow an address at once: its town, with or without a post code."""
    r = f.rng
    if kind != "address" or r.random() < 0.6:
        return []
    code = r.choice(["", "", "", f"{f.digits(5)} ", f"{f.digits(5)} ", f"{f.digits(2)}-{f.digits(3)} ", f"{f.digits(4)} "])
    return [((", " + code if code else r.choice([", ", ", ", " in ", " ("])) + f.place(lang), "")]


def _after(f: Filler, lang: str, kind: str, forms: str) -> list[tuple[str, str]]:
    r, out = f.rng, _town(f, lang, kind)
    if r.random() < 0.3:
        out += f.fill(" " + r.choice(_of(TAILS[lang].split("|"), forms)), lang)
    return out + [(r.choice(["", ".", ".", ".", ";", ",", "!", " "]), "")]


def _positive(f: Filler, lang: str, kind: str, forms: str) -> list[tuple[str, str]]:
    """A line with one to three labelled stretches."""
    r = f.rng
    x = r.random()
    kinds = [kind, *r.sample([k for k in LABELLED if k != kind], r.choice([0, 0, 1, 1, 2]))]
    if x < 0.1:  # a list or a line of nothing else
        lead = r.choice(["", "* ", "# ", ": ", "** ", "- ", "|| ", "|"])
        out = [(lead, "")]
        for i, k in enumerate(kinds):
            out += [(r.choice([", ", " || ", " – ", " / ", "; ", " "]), "")] * (i > 0) + f.fill("{%s}" % k, lang)
        return out + _after(f, lang, kinds[-1], forms)
    if x < 0.2:  # a field of a template or table
        return [(f"| {r.choice(_of(FIELDS[kind].split('|'), forms))}{r.choice([' = ', '=', ' = '])}", ""), *f.fill("{%s}" % kind, lang), *(_after(f, lang, kind, forms) if r.random() < 0.3 else [])]
    if x < 0.26:  # a row of a table
        out = [(r.choice(["| ", "|"]) + (f.slot("word", lang) + " || " if r.random() < 0.3 else ""), "")]
        for i, k in enumerate(kinds):
            out += [(" || ", "")] * (i > 0) + f.fill("{%s}" % k, lang)
        return out + [(r.choice(["", " || " + f.slot("n2", lang)]), "")]
    if x < 0.36:  # a signature, or a name with something in brackets
        out = [(r.choice([f.slot("word", lang).capitalize() + ". --", "-- ", "– ", ":: ", "", f"{f.slot('word', lang).capitalize()} {f.slot('word', lang)}. ", "--"]), ""), *f.fill("{name}", lang)]
        if r.random() < 0.7:
            k = r.choice(["email", "phone", "id_number", "email"])
            out += [(r.choice([" (", " (", ", ", " <"]), "")] + (_stretch(f, lang, k, forms) if r.random() < 0.4 else f.fill("{%s}" % k, lang)) + [(r.choice([")", ")", ">", ""]), "")]
        return out + f.fill(r.choice(["", " {n2}:{n2}, {n1} May {year}", ", {n1} June {year}", " {n2}:{n2}, {date} (UTC)", " {word} the {word}.", "."]), lang)
    out: list[tuple[str, str]] = []
    if x < 0.48:  # a person as the subject
        head = r.choice(_of(OPENINGS, forms))
        out = f.fill((head + " " if head else "") + "{name} " + r.choice(_of(PREDICATES, forms)) + " ", lang)
        for i, k in enumerate(kinds):
            out += [(r.choice([" and ", ", ", " or ", " "]), "")] * (i > 0) + f.fill("{%s}" % k, lang) + _town(f, lang, k)
        return out + f.fill(r.choice(["", ".", "!", " and {word} the {word}", " and everyone {word}", " every {word}.", "!!"]), lang)
    for i, k in enumerate(kinds):
        out += [(r.choice([", ", ", ", " or ", " and ", "; ", " ", ". ", " at "]), "")] * (i > 0)
        out += _stretch(f, lang, k, forms) if i == 0 or r.random() < 0.5 else f.fill("{%s}" % k, lang)
        out += _town(f, lang, k) if i + 1 < len(kinds) else []
    out += _after(f, lang, kinds[-1], forms)
    if x < 0.55:  # in a comment, note or quotation
        a, b = r.choice([("<!-- ", " -->"), ("<ref>", "</ref>"), ("{{quote|", "}}"), ("''", "''"), ("<small>", "</small>"), ("(", ")"), ("{{note|", "|letter}}")])
        out = [(a, ""), *out, (b, "")]
    elif x < 0.72:
        out = f.fill(r.choice(["{word} ", "The {word}: ", "* ", ": ", "'''{word}:''' ", "lol ", "I {word} ", "{place} {word}, ", "{org}, ", "In {year} ", "{word} {word} {word} "]), lang) + out
    return out


def labelled_rows(given: list[str], surnames: list[str], n: int, seed: int, forms: str = "all") -> list[list[tuple[str, str]]]:
    """``n`` labelled lines of one to four parts; half of them hold personal information. ``forms``: all, trained or held out."""
    f = Filler(given, surnames, seed)
    r, out, langs = f.rng, [], ["en"] * 6 + ["de", "fr", "es", "pl", "ru"]
    for i in range(n):
        lang = r.choice(langs)
        plain = lambda: f.fill(r.choice(_of(PLAIN[lang], forms) if r.random() < 0.9 or lang == "en" else PLAIN["en"]), lang)  # noqa: B023, E731
        parts = [_positive(f, lang, LABELLED[i // 2 % len(LABELLED)], forms) if k == 0 and i % 2 == 0 else plain() for k in range(r.choice([1, 1, 1, 2, 3]))]
        r.shuffle(parts)
        line: list[tuple[str, str]] = []
        for k, p in enumerate(parts):
            line += ([(" ", "")] if k else []) + p
        cyrillic, labelled = any("а" <= c <= "я" for t, _ in line for c in t), any(label for _, label in line)
        if not labelled and r.random() < 0.05:  # shouted
            line = [(t.upper(), label) for t, label in line]
        if r.random() < (0.0 if cyrillic and labelled else 0.4 if cyrillic else 0.08):  # text read in the wrong encoding
            line = [(t.encode().decode("latin-1"), label) for t, label in line]
        out.append([(t, label) for t, label in line if t])
    return out
