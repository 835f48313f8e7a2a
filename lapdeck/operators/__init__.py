"""Table operators: every function maps DataFrame(s) + a column spec to a
DataFrame.  No operator collects data to the driver."""
