"""Plans: KPI tables built from the operators, the metric registry and the
batch job that writes and assembles them."""
