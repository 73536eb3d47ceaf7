"""Named datasets and reports: dims (organisation, geography, people),
facts (event / participation grain), reports (consolidated sheets), legacy
(single-brand sheets) and blocks (one operator per query)."""
