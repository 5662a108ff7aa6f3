"""Sources and sinks.

files         csv / json readers, snake_case standardiser, raw ``prepare``
xlsx          xlsx reader (binaryFile + mapInArrow, streaming expat scan)
rule_catalog  the shipped rules, rules from a file, active-rule selection
tables        zones, full-refresh writes counted by Observation, views, previews
bridge        the benchmark tables presented as the retail source datasets
landing       write bridged data as xlsx / csv / json source files
"""
