"""DataFrame operators over tagged series: rows have keys, ``ms`` (event time), ``seq`` (arrival) and ``value``."""
