"""Gazetteer: place names to canonical places, by rules in a fixed order; the first that fits wins."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The places that are written as they are.
ALLOWED = (
    "台北市 新北市 桃園市 台中市 台南市 高雄市 基隆市 新竹市 嘉義市 宜蘭縣 花蓮縣 台東縣 南投縣 彰化縣 雲林縣 屏東縣 苗栗縣 新竹縣 嘉義縣 "
    "澎湖縣 金門縣 連江縣 香港 中國 美國 加沙 以色列 烏克蘭 歐盟 日本 韓國 台灣 澳門 "
    "英國 法國 德國 義大利 西班牙 葡萄牙 荷蘭 比利時 盧森堡 瑞士 奧地利 愛爾蘭 丹麥 瑞典 挪威 芬蘭 冰島 "
    "波蘭 捷克 匈牙利 斯洛伐克 斯洛維尼亞 克羅埃西亞 羅馬尼亞 保加利亞 希臘 愛沙尼亞 拉脫維亞 立陶宛 白俄羅斯 摩爾多瓦 馬爾他 賽普勒斯 塞爾維亞 "
    "波士尼亞與赫塞哥維納 蒙特內哥羅 北馬其頓 阿爾巴尼亞 科索沃 俄羅斯 加拿大 澳大利亞 紐西蘭 "
    "北韓 蒙古 新加坡 馬來西亞 印尼 泰國 越南 菲律賓 柬埔寨 寮國 汶萊 東帝汶 印度 巴基斯坦 孟加拉 斯里蘭卡 尼泊爾 不丹 馬爾地夫 "
    "哈薩克 烏茲別克 吉爾吉斯 土庫曼 塔吉克 土耳其 伊朗 伊拉克 敘利亞 黎巴嫩 約旦 埃及 "
    "沙烏地阿拉伯 阿拉伯聯合大公國 卡達 科威特 巴林 阿曼 也門 巴勒斯坦 約旦河西岸 "
    "墨西哥 巴西 阿根廷 智利 秘魯 哥倫比亞 委內瑞拉 厄瓜多 玻利維亞 烏拉圭 巴拉圭 古巴 多明尼加 海地 瓜地馬拉 薩爾瓦多 宏都拉斯 尼加拉瓜 哥斯大黎加 巴拿馬 "
    "牙買加 巴貝多 千里達及托巴哥 巴哈馬 南非 奈及利亞 衣索比亞 肯亞 坦尚尼亞 烏干達 盧安達 迦納 象牙海岸 塞內加爾 "
    "喀麥隆 摩洛哥 阿爾及利亞 突尼西亞 利比亞 蘇丹 南蘇丹 索馬利亞 安哥拉 納米比亞 波札那 尚比亞 辛巴威 剛果民主共和國 剛果共和國 馬達加斯加 模里西斯 "
    "帛琉 所羅門群島 馬紹爾群島 吐瓦魯 諾魯 吉里巴斯 密克羅尼西亞聯邦 巴布亞紐幾內亞 斐濟 薩摩亞 東加 萬那杜 國際"
).split()
#: County, pattern.
TAIWAN = (
    ("台北市", "(台|臺)北(市|$|市政府|市府|市議會|市警|市警局)"), ("新北市", "新北(市|$|市政府|市府|市議會|市警|市警局)"),
    ("桃園市", "桃園(市|$|市政府|市府|機場)"), ("台中市", "(台|臺)中(市|$|市政府|市府|市警|捷運)"),
    ("台南市", "(台|臺)南(市|$|市政府|市府|市警)"), ("高雄市", "高雄(市|$|市政府|市府|市警|捷運|山區)"),
    ("基隆市", "基隆(市|$)"), ("新竹市", "新竹市"), ("新竹縣", "新竹縣"), ("嘉義市", "嘉義市"), ("嘉義縣", "嘉義縣"),
    ("宜蘭縣", "宜蘭(縣|$)"), ("花蓮縣", "花蓮(縣|$)"), ("台東縣", "(台|臺)東(縣|$)"), ("南投縣", "南投(縣|$)"),
    ("彰化縣", "彰化(縣|$)"), ("雲林縣", "雲林(縣|$)"), ("屏東縣", "屏東(縣|$)|恆春|墾丁|小墾丁"), ("苗栗縣", "苗栗(縣|$)"),
    ("澎湖縣", "澎湖(縣|$)|澎湖沿岸|馬公"), ("金門縣", "金門(縣|$)"), ("連江縣", "(連江|馬祖)"),
)
Aliases = Sequence[tuple[str, Sequence[str]]]


def load_aliases(path: str | Path) -> Aliases:
    """Places and their names in the order of the file's lines, ``place: names``; names in compatibility normal form."""
    lines = Path(path).read_text("utf-8").splitlines()
    pairs = [line.split(": ") for line in lines if line and not line.startswith("#")]
    return tuple((place, tuple(unicodedata.normalize("NFKC", n) for n in names.split())) for place, names in pairs)


#: The names of countries and territories; a parameter of all functions below.
ALIASES = load_aliases(Path(__file__).parent.parent / "data" / "place_aliases.txt")
#: Place, pattern.
SUPPLEMENTAL = (
    ("美國", "白宮|華府|美軍|矽谷|加州|德州|佛州|紐約|洛杉磯|舊金山|西雅圖|波士頓|芝加哥|華盛頓"),
    ("中國", "北京|上海|天津|重慶|廣東|深圳|廣州|福建|浙江|江蘇|山東|河北|河南|湖南|湖北|江西|安徽|山西|陝西|四川|雲南|貴州|遼寧|吉林|黑龍江|甘肅|青海|內蒙古|寧夏|新疆|西藏|海南|廣西|蘇州|南京|合肥|青島|哈爾濱|廈門|武漢|成都"),
    ("以色列", "特拉維夫|耶路撒冷|海法"), ("烏克蘭", "基輔|哈爾科夫|敖德薩|赫爾松|頓涅茨克|盧甘斯克"),
    ("歐盟", "布魯塞爾|歐盟委員會|歐洲議會|EU"), ("約旦河西岸", "約旦河西岸|西岸|WestBank"), ("加沙", "加薩|加沙"),
)
#: Region, its other names, its counties.
REGIONS = (
    ("台灣-北部", ("北臺灣", "北台灣", "北部", "北部沿海", "大台北", "北北基"), ("台北市", "新北市", "基隆市", "桃園市", "新竹市", "新竹縣", "宜蘭縣")),
    ("台灣-中部", ("中臺灣", "中台灣", "中部", "桃竹苗"), ("台中市", "苗栗縣", "彰化縣", "南投縣", "雲林縣")),
    ("台灣-南部", ("南臺灣", "南台灣", "南部", "高屏", "雲嘉南"), ("台南市", "高雄市", "屏東縣", "嘉義縣", "嘉義市", "雲林縣")),
    ("台灣-東部", ("東臺灣", "東台灣", "東部"), ("宜蘭縣", "花蓮縣", "台東縣")),
    ("台灣-西部", ("西部",), ("基隆市", "台北市", "新北市", "桃園市", "新竹市", "新竹縣", "苗栗縣", "台中市", "彰化縣", "南投縣", "雲林縣", "嘉義縣", "嘉義市", "台南市", "高雄市", "屏東縣")),
    ("台灣-花東", ("花東", "花東地區"), ("花蓮縣", "台東縣")),
    ("台灣-離島", ("離島",), ("澎湖縣", "金門縣", "連江縣")),
)
#: Pattern of a finer place, its county.
KEYWORDS = (
    ("(太|臺)麻里", "台東縣"), ("綠島", "台東縣"), ("成功鎮|關山|池上|長濱", "台東縣"), ("恆春|墾丁|車城|枋山|滿州", "屏東縣"),
    ("恆春半島|小墾丁", "屏東縣"), ("花東|花東縱谷", "花蓮縣"), ("大台北|北北基", "台北市"),
)

_KNOWN = frozenset(ALLOWED)


def squeezed(c: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", "")


def _alias_pattern(names: Sequence[str]) -> str:
    latin = [re.escape(n) for n in names if re.search("[A-Za-z]", n)]
    other = [re.escape(n) for n in names if not re.search("[A-Za-z]", n)]
    return "|".join([*other, *[f"(?i:(?<![A-Za-z0-9]){n}(?![A-Za-z0-9]))" for n in latin]])


def rules(aliases: Aliases = ALIASES) -> list[tuple[str, str]]:
    """(pattern, place) in the order in which they are tried after the exact names."""
    out = [(f"(?i){p}", place) for place, p in TAIWAN]
    out += [(_alias_pattern(names), place) for place, names in aliases if place in ALLOWED]
    return out + [(f"(?i){p}" if place in ("歐盟", "約旦河西岸", "加沙") else p, place) for place, p in SUPPLEMENTAL]


def canonical_place(c: Column, aliases: Aliases = ALIASES) -> Column:
    """The place of a name, null where no rule fits. For names in compatibility normal form."""
    s = squeezed(c)
    return F.coalesce(F.when(s.isin(*ALLOWED), s), *[F.when(s.rlike(p), place) for p, place in rules(aliases)])


def place_of(name: str | None, tried: Sequence[tuple[re.Pattern, str]]) -> str | None:
    """The same of one name, by compiled rules."""
    s = re.sub(r"\s+", "", unicodedata.normalize("NFKC", name or ""))
    return s if s in _KNOWN else next((place for rx, place in tried if rx.search(s)), None)


def canonicalized(df: DataFrame, column: str, name: str = "place", aliases: Aliases = ALIASES) -> DataFrame:
    """df with the place of each value of ``column``, brought to compatibility normal form; null where no rule fits.

    Rules are tried once for each distinct value, in Arrow batches: as one expression they would be too
    long to be compiled. Nulls have no place.
    """
    found_by = rules(aliases)

    @F.pandas_udf("string")
    def of(names: pd.Series) -> pd.Series:
        tried = [(re.compile(p), place) for p, place in found_by]
        return names.map(lambda n: place_of(n, tried))

    found = df.select(column).distinct().withColumn(name, of(column))
    return df.join(found.filter(F.col(name).isNotNull()), column, "left")


def expanded_places(tokens: Column, text: Column, aliases: Aliases = ALIASES) -> Column:
    """All places that tokens and text name, regions replaced by their counties; sorted, without repeats."""
    s = squeezed(text)
    names = sorted(((n, region, counties) for region, names, counties in REGIONS for n in names), key=lambda x: -len(x[0]))
    pattern = "|".join(n for n, _, _ in names)  # longer names first
    by_name = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for n, _, c in names for x in (n, c)])
    found = lambda c: F.flatten(F.transform(F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1)), lambda a: F.element_at(by_name, a)))
    of_text = [F.when(s.rlike(p), county) for p, county in KEYWORDS] + [F.when(s.rlike("花東"), p) for p in ("花蓮縣", "台東縣")]
    of_text += [F.when(s.rlike(p), place) for p, place in rules(aliases)[len(TAIWAN) :]]
    plain = F.transform(F.coalesce(tokens, F.array().cast("array<string>")), squeezed)
    every = F.concat(
        F.array_compact(F.transform(plain, lambda t: canonical_place(t, aliases))), F.flatten(F.transform(plain, found)), found(s), F.array_compact(F.array(*of_text))
    )
    return F.array_sort(F.array_distinct(every))


def expanded_mentions(mentions: DataFrame, names: DataFrame, aliases: Aliases = ALIASES) -> DataFrame:
    """(id, places): ``expanded_places`` of the first mention as token and all mentions, a comma apart, as text.

    ``mentions``: id, raw, pos; ``names``: each raw once. No rule fits across a comma, and none of a text asks for its
    end, so the places of the text are those of its names: rules are tried once for each name.
    """
    none = F.array().cast("array<string>")
    known = names.select("raw", expanded_places(none, F.col("raw"), aliases).alias("x"), expanded_places(F.array("raw"), F.lit(""), aliases).alias("y"))
    got = mentions.join(F.broadcast(known), "raw", "left").groupBy("id").agg(F.flatten(F.collect_set("x")).alias("x"), F.min_by("y", "pos").alias("y"))
    return got.select("id", F.array_sort(F.array_distinct(F.concat("x", F.coalesce("y", none)))).alias("places"))


def place_detail(df: DataFrame, keys: list[str], place: str, seen: str) -> DataFrame:
    """One row for each key: places_in_detail (place, frequency), the most frequent first, then the first seen."""
    counted = df.filter(F.col(place).isNotNull()).groupBy(*keys, place).agg(F.count("*").alias("frequency"), F.min(seen).alias("at"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("frequency")).alias("o"), "at", F.col(place).alias("place"), "frequency")))
    return counted.groupBy(*keys).agg(F.transform(ordered, lambda x: F.struct(x.place.alias("place"), x.frequency.alias("frequency"))).alias("places_in_detail"))
