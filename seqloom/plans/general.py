"""Queries of the general problems."""

from ..operators.archive import p1_assemblies, p1_found, p1_index, p1_lookup
from ..operators.orphans import p6_found
from ..operators.treeagg import p5_bins, p5_found, p5_sags, p5_species

GENERAL = {f.__name__: f for f in (p1_found, p1_index, p1_assemblies, p1_lookup, p5_found, p5_species, p5_bins, p5_sags, p6_found)}
