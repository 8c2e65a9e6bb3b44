"""Texts put together from parts, so that a test knows what it wrote."""


def day(d):
    return f"{d.year}年{d.month}月{d.day}日"


def report(us=None, funds="--", holdings=(), net=("100.00",), spaced=False):
    """A periodic report: share of one country, fund position, holdings ``(name, kind, manager, values)``."""
    gap = " " if spaced else ""
    lines = ["", "4.期末基金资产净值 " + " ".join(net), "5.期末基金份额净值 1.00", "5.1 报告期末基金资产组合情况",
             "1 权益投资 7.00 7.00", f"2 基金投资 {funds}", "3 合计 88.00 88.00",
             f"5.2 报告期末在各个国家（地区）证券市场的股票及存托凭证投资分{gap}布", "国家 公允价值 比例"]
    lines += [f"美国 {us} {us}"] if us else ["日本 7.00 7.00"]
    lines += ["合计 7.00 7.00", "5.3 行业分类"]
    if holdings:
        lines += [f"5.9 报告期末按公允价值排序的前十名基金投资明{gap}细"]
        lines += [f"{i} {name} {kind} {manager} {values}" for i, (name, kind, manager, values) in enumerate(holdings, 1)]
        lines += ["5.10 投资组合报告附注"]
    return "\n".join(lines) + "\n"
