"""Column expressions shared by the marts, features and reports."""
