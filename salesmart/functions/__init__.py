"""Column-expression builders (no DataFrame operations).

cleaning  blank -> null trim, customer / product / order cleaning, date parsing
rules     rule record, 12-type compiler registry, one reasons expression
"""
