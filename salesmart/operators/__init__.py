"""DataFrame -> DataFrame operators.

quality  annotate / split, duplicate-key and dangling-key exception sets,
         reference flags, rule failure counts, status / reason counts
star     dimension projections, the order_sales fact, cardinality guard
marts    profit mart, the four reports (DataFrame and SQL forms), previews
"""
