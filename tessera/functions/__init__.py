"""Column-expression helpers, evaluated in the JVM.  Plain expressions take
part in whole-stage code generation; higher-order functions (lambdas over
arrays) are interpreted per row."""
