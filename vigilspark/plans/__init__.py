"""The models: reports, child tables, marts, signals and the queries users run on them."""
