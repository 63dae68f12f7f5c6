"""Column functions for parliamentary text. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hemicycle import dims

TAG = "<[^>]+>"
REFERENCE = "[0-9]{3}/[0-9]{6}"


def strip_tags(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, TAG, ""))


def plain_text(x: Column) -> Column:
    """Text of serialised content: runs of four and three line breaks become a new line and single ones a space, runs of
    spaces are shortened, tags go and the entities of XML and of Latin letters are replaced, & last."""
    x = F.regexp_replace(x, r"(?:<br>){3,4}", "\n")
    for old in ("<br>", "    ", "   ", "  "):
        x = F.replace(x, F.lit(old), F.lit(" "))
    x = F.regexp_replace(x, TAG, "")
    for name, char in dims.ENTITIES.items():
        x = F.replace(x, F.lit(f"&{name};"), F.lit(char))
    return x


def age(birth: Column, as_of: Column) -> Column:
    """Full years."""
    return F.floor(F.months_between(as_of, birth) / 12).cast("int")


def squeeze(x: Column) -> Column:
    """White space runs become one space."""
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def after(hay: Column, needle: str) -> Column:
    """What follows the first ``needle``; without one, the text less its first len(needle) - 1 characters."""
    return F.substr(hay, F.locate(needle, hay) + len(needle))


def sentences(x: Column) -> Column:
    """Split at full stops that no digit follows; empty pieces go."""
    return F.filter(F.split(x, r"\.(?!\d)"), lambda s: s != "")


def without_dot(x: Column) -> Column:
    return F.regexp_replace(x, r"\.$", "")


def title_of(full: Column, reference: Column) -> Column:
    """Drop the trailing " (reference)"."""
    return F.substring(full, F.lit(1), F.length(full) - F.length(reference) - 3)


def reference(number: Column, code: Column) -> Column:
    return F.concat(code, F.lit("/"), F.format_string("%06d", number))


def initiative_id(ref: Column) -> Column:
    return F.replace(ref, F.lit("/"), F.lit("-"))


def first_last(name: Column) -> Column:
    """"Last, First" to "First Last"."""
    return F.trim(F.array_join(F.reverse(F.split(name, ",")), " "))


def slug(x: Column) -> Column:
    plain = F.translate(F.lower(x), "áéíóúüñçàèìòùâêîôû", "aeiouuncaeiouaeiou")
    return F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9]+", "-"), "^-|-$", "")


def title_case(x: Column) -> Column:
    """Upper case after anything but a letter, as in Pérez-López; initcap looks at spaces only."""
    return F.array_join(F.transform(F.regexp_extract_all(x, F.lit(r"(\p{L}+|[^\p{L}]+)"), 1), lambda w: F.initcap(w)), "")


def link(href: Column) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit("http://"), href))


def email(x: Column) -> Column:
    """The address, or null where it isn't one; case doesn't matter."""
    user, domain = F.regexp_extract(x, "^(.*)@[^@]*$", 1), F.regexp_extract(x, "@([^@]*)$", 1)
    ok = user.rlike("^[A-Za-z0-9!#$%&'*+/=?^_`{}|~-]+(\\.[A-Za-z0-9!#$%&'*+/=?^_`{}|~-]+)*$") & domain.rlike("^([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?\\.)+[A-Za-z]{2,}$")
    return F.when(ok, x)


def parse_date(x: Column) -> Column:
    return F.try_to_timestamp(x, F.lit("dd/MM/yyyy")).cast("timestamp_ntz")


def latest_date(x: Column, as_of: str) -> Column:
    """The greatest dd/mm/yyyy in the text that lies before ``as_of``."""
    found = F.transform(F.regexp_extract_all(x, F.lit("([0-9]{1,2}/[0-9]{2}/[0-9]{4})"), 1), lambda d: F.try_to_timestamp(d, F.lit("d/MM/yyyy")).cast("timestamp_ntz"))
    return F.array_max(F.filter(found, lambda d: d < F.lit(as_of).cast("timestamp_ntz")))


_ROMAN = [["", *"I II III IV V VI VII VIII IX".split()], ["", *"X XX XXX XL L LX LXX LXXX XC".split()], ["", *"C CC CCC CD D DC DCC DCCC CM".split()], ["", "M", "MM", "MMM"]]


def roman(n: Column) -> Column:
    """1 to 3999; 0 gives an empty string."""
    digit = lambda k: F.get(F.array(*map(F.lit, _ROMAN[k])), (F.floor(n / 10**k) % 10).cast("int"))
    return F.when(n.between(0, 3999), F.concat(*(digit(k) for k in (3, 2, 1, 0))))


def status(last_item: Column, code: Column) -> Column:
    """Status by the last history item; the first rule that holds wins."""
    found = F.when(code == "070", dims.APPROVED).when(last_item.isNull(), dims.UNKNOWN)
    for name, pattern, only, without in dims.STATUS_RULES:
        hit = last_item.rlike(f"(?iu){pattern}")
        if only:
            hit = hit & code.isin(*only)
        if without:
            hit = hit & ~code.isin(*without)
        found = found.when(hit, name)
    return found.otherwise(dims.UNKNOWN)


def is_final(name: Column) -> Column:
    return ~F.coalesce(name, F.lit(dims.UNKNOWN)).isin(dims.OPEN, dims.UNKNOWN)


def is_final_word(state: Column) -> Column:
    return state.rlike("(?iu)" + "|".join(dims.FINAL_WORDS))


def next_phase(phase: Column) -> Column:
    """(position, name) of the phase that follows; (-1, '') after the last."""
    names = dims.PHASES
    found = F.when(phase == "", F.struct(F.lit(0).alias("position"), F.lit(names[0]).alias("phase")))
    for i in range(len(names) - 1):
        found = found.when(phase == names[i], F.struct(F.lit(i + 1).alias("position"), F.lit(names[i + 1]).alias("phase")))
    return found.otherwise(F.struct(F.lit(-1).alias("position"), F.lit("").alias("phase")))


def gender(header: Column) -> Column:
    return F.when(F.split(F.trim(header), r"\s+")[0] == "Diputada", "Mujer").otherwise("Hombre")


def constituency(header: Column) -> Column:
    parts = F.split(F.trim(header), r"\s+")
    return F.array_join(F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0))), " ")


def bulletin_slice(content: Column, page: Column, ref: Column) -> Column:
    """Lines between the initiative's own reference (on its page) and the next reference."""
    mark = F.concat(F.lit("Página "), page)
    start = F.substr(content, F.call_function("locate", mark, content) + F.length(mark))
    rest = F.substr(start, F.call_function("locate", ref, start) + F.length(ref))
    end = F.regexp_instr(rest, F.lit(REFERENCE))
    return F.split(F.when(end > 0, F.substr(rest, F.lit(1), end - 1)).otherwise(rest), "\n")
