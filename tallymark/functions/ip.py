"""IP addresses as numbers, and province and city of a location's name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Provinces by how their names are written.
MUNICIPALITIES = ("北京", "上海", "天津", "重庆", "香港", "澳门")
REGIONS = ("广西", "宁夏", "新疆", "西藏")
LONG_NAMES = ("内蒙古", "黑龙江")
PROVINCES = ("辽宁", "吉林", "河北", "山西", "江苏", "浙江", "安徽", "福建", "江西", "山东", "河南", "湖北", "湖南", "广东", "海南", "四川", "贵州", "云南", "陕西", "甘肃", "青海", "台湾")


def ip_number(ip: Column) -> Column:
    """Four octets as a long; null for anything else."""
    part = F.transform(F.split(F.trim(ip), "[.]"), lambda x: F.when(x.rlike("^[0-9]{1,3}$"), x.try_cast("long")))
    ok = (F.size(part) == 4) & F.forall(part, lambda x: x.isNotNull() & (x <= 255))
    return F.when(ok, F.aggregate(part, F.lit(0).cast("long"), lambda acc, x: acc * 256 + x))


def province_city(name: Column) -> Column:
    """struct(province, city) of a location's name, null if it begins with no province."""
    two, three = F.substring(name, 1, 2), F.substring(name, 1, 3)
    no_city = lambda x: F.regexp_replace(x, "市+$", "")
    rest2, rest3 = F.substring(name, 3, 1 << 30), F.substring(name, 4, 1 << 30)
    made = lambda p, c: F.struct(p.alias("province"), c.alias("city"))
    region = F.when(rest2.contains("自治区"), F.regexp_replace(rest2, "(?s)^.*?自治区", "")).otherwise(rest2)
    return (
        F.when(two.isin(*MUNICIPALITIES), made(two, two))
        .when(two.isin(*REGIONS), made(two, no_city(region)))
        .when(three.isin(*LONG_NAMES), made(three, no_city(rest3)))
        .when(two.isin(*PROVINCES), made(two, no_city(F.regexp_replace(rest2, "^省+", ""))))
    )
